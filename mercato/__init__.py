"""Marketplace-listing analytics on PySpark DataFrames."""
