"""One row per key under a stated total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.sources.tables import stage

_RANK = "_row_rank"


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key. Spark keeps at most one row per key and input partition before the
    exchange (a partial window group limit), so a key holding a large share of the rows is reduced
    to a row per task before it meets in one place."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_first_wide(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``keep_first`` for rows that carry texts: the rows are stored once, the first per key is chosen on keys, order and the place of
    a row, and the chosen rows are fetched by their place through a hash join. No sort and no window moves a text."""
    stored = stage(df, "wide-rows")
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    ranks = [(o if isinstance(o, Column) else F.col(o)) for o in order]
    narrow = keep_first(stored.select(*keys, *stored.columns, *place), keys, [*ranks, "_file", "_row"]).select("_file", "_row")
    return stored.select("*", *place).join(narrow.hint("shuffle_hash"), ["_file", "_row"], "left_semi").select(*df.columns)


def with_ties(df: DataFrame, keys: Sequence[str], value: str, *, largest: bool = False) -> DataFrame:
    """All rows that hold the smallest (or largest) ``value`` of their key. The best value combines
    before its exchange and is then looked up by key and value, so no key gathers in one task."""
    best = df.groupBy(*keys).agg((F.max if largest else F.min)(value).alias(value))
    return df.join(best, [*keys, value], "inner").select(*df.columns)


def drop_missing(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which every named text column is neither NULL nor blank."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return df
