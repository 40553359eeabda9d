"""Operators for preparing training corpora.

Functions of this subpackage that run inside tasks travel with the task, so executors need no installed copy."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
