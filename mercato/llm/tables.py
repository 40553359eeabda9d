"""Small tables beside large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from mercato.sources.tables import stage

#: A lookup table of at most this many rows is broadcast.
BROADCAST_ROWS = 20_000


def lookup(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table written once, and broadcast if a count finds at most ``rows`` rows; a table beyond that is
    joined as Spark decides (by shuffle, skewed keys split)."""
    small = stage(small, "lookup")
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def widened(df: DataFrame, **columns: DataType) -> StructType:
    """The schema with columns added."""
    return StructType([*df.schema.fields, *[StructField(n, kind) for n, kind in columns.items()]])
