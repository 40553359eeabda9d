"""Keyed upsert and type-2 history as joins of DataFrames. Nothing here writes; see sources.tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERSION_COLUMNS = ["hash", "valid_from", "valid_to"]


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the batch: rows of equal key replaced, new keys added, others untouched.
    The batch must hold a key once."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(batch.select(*target.columns))


def replaced(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same as ``upsert`` as one full join, which keeps a target that is already partitioned by its keys where it is."""
    columns = target.columns
    old = target.select(*keys, F.struct(*columns).alias("_old"))
    new = batch.select(*keys, F.struct(*columns).alias("_new"))
    return old.join(new, list(keys), "full").select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def _stamp(ts: datetime | Column) -> Column:
    return (ts if isinstance(ts, Column) else F.lit(ts)).cast("timestamp")


def scd2_new(current: DataFrame, batch: DataFrame, ts: datetime | Column, key: str = "id") -> DataFrame:
    """The versions a batch opens at ``ts``: of keys without a current version, and of changed hash. The
    current versions are first reduced to the keys of the batch."""
    before = current.join(batch.select(key), key, "left_semi").select(key, F.col("hash").alias("_old_hash"))
    changed = F.col("_old_hash").isNull() | (F.col("_old_hash") != F.col("hash"))
    new = batch.join(before, key, "left").filter(changed)
    new = new.withColumns({"valid_from": _stamp(ts), "valid_to": F.lit(None).cast("timestamp")})
    return new.select(*current.columns)


def scd2_closed(current: DataFrame, batch: DataFrame, ts: datetime | Column, key: str = "id") -> DataFrame:
    """The current versions a batch closes at ``ts``: those whose hash it changes."""
    incoming = batch.select(key, F.col("hash").alias("_new_hash"))
    changed = current.join(incoming, key, "inner").filter(F.col("_new_hash") != F.col("hash"))
    return changed.withColumn("valid_to", _stamp(ts)).select(*current.columns)


def scd2_step(current: DataFrame, batch: DataFrame, ts: datetime | Column, key: str = "id") -> DataFrame:
    """What becomes of the current versions under a batch: kept, closed at ``ts`` (valid_to set) and new
    (valid from ``ts``). Equal hash leaves a row as it is; keys the batch lacks stay current. Both sides
    hold a key once.

    The current versions stream past the keys and hashes of the batch, so a batch small enough to
    broadcast moves none of them; a full outer join would shuffle and sort them all."""
    incoming = batch.select(key, F.col("hash").alias("_new_hash"))
    end = F.when(F.col("_new_hash") != F.col("hash"), _stamp(ts)).otherwise(F.lit(None).cast("timestamp"))
    kept = current.join(incoming, key, "left").withColumn("valid_to", end).select(*current.columns)
    return kept.unionByName(scd2_new(current, batch, ts, key))


def scd2_apply(table: DataFrame, batch: DataFrame, ts: datetime | Column, key: str = "id") -> DataFrame:
    """The whole history table after a batch. Closed versions pass by the join untouched."""
    closed = table.filter("valid_to IS NOT NULL")
    return closed.unionByName(scd2_step(table.filter("valid_to IS NULL"), batch, ts, key))


def scd2_splice(stored: DataFrame, states: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """The versions of the keys of ``states`` (rows with ``valid_from``, the time that they tell of) after the stored versions of
    these keys and the states are put in order of time. A state is true until the next one of its key, wherever it falls: runs of equal hash become one
    version, a version in whose time another state falls ends there, and one that a late state repeats begins earlier. A version that was ended
    with none after it (see ``close_missing``) stays ended. At one time a state stands before a stored version, and a version before an end.

    ``stored`` must hold all versions that are open or end at the earliest of the states or later. A key's rows are as many as its
    versions from then on."""
    plain = [c for c in columns if c not in (*VERSION_COLUMNS, key)]
    told = states.select(key, *plain, "hash", "valid_from", F.lit(2).alias("_rank"))
    held = stored.select(key, *plain, "hash", "valid_from", F.lit(1).alias("_rank"))
    ends = stored.filter("valid_to IS NOT NULL").select(
        key, *[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in plain], F.lit(None).cast("string").alias("hash"),
        F.col("valid_to").alias("valid_from"), F.lit(0).alias("_rank"),
    )
    events = told.unionByName(held).unionByName(ends)
    # windows of one partitioning, each sorted as the one before it: the rows move once
    by_rank = Window.partitionBy(key).orderBy("valid_from", F.col("_rank").desc())
    in_time = Window.partitionBy(key).orderBy("valid_from")
    events = events.withColumn("_last", F.lag("valid_from").over(by_rank)).filter("_last IS NULL OR _last <> valid_from")
    before = F.lag(F.coalesce("hash", F.lit(""))).over(in_time)
    starts = events.withColumn("_before", before).filter(
        F.col("_before").isNull() | (F.col("_before") != F.coalesce("hash", F.lit("")))
    )
    spliced = starts.withColumn("valid_to", F.lead("valid_from").over(in_time)).filter("hash IS NOT NULL")
    return spliced.select(*columns)


def scd2_changes(stored: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """The rows of both that the other lacks: stored versions that are no more (``gone``) and new or changed ones."""
    columns = stored.columns
    mark = ["hash", "valid_to"]
    old = stored.select(key, "valid_from", F.struct(*columns).alias("_old"))
    new = after.select(key, "valid_from", F.struct(*columns).alias("_new"))
    both = old.join(new, [key, "valid_from"], "full")
    same = F.lit(True)
    for c in mark:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    differ = F.col("_old").isNull() | F.col("_new").isNull() | ~same
    sides = F.array(F.struct(F.lit(True).alias("gone"), F.col("_old").alias("row")), F.struct(F.lit(False).alias("gone"), F.col("_new").alias("row")))
    return both.filter(differ).select(F.explode(sides).alias("x")).filter("x.row IS NOT NULL").select("x.row.*", "x.gone")


def close_missing(table: DataFrame, batch: DataFrame, ts: datetime | Column, key: str = "id") -> DataFrame:
    """Optional: also close current versions whose key the batch lacks."""
    present = batch.select(key, F.lit(True).alias("_present")).distinct()
    joined = table.join(present, key, "left")
    gone = F.col("valid_to").isNull() & F.col("_present").isNull()
    end = F.when(gone, _stamp(ts)).otherwise(F.col("valid_to"))
    return joined.withColumn("valid_to", end).select(*table.columns)


def scd2_history(states: DataFrame, key: str, batch: str, hash_col: str = "hash") -> DataFrame:
    """All versions that applying the batches one by one leaves, without the loop. ``states`` holds a
    key at most once per batch, so a key has no more rows than there are batches."""
    per_key = Window.partitionBy(key).orderBy(batch)
    before = F.lag(hash_col).over(per_key)
    starts = states.withColumn("_before", before).filter(
        F.col("_before").isNull() | (F.col("_before") != F.col(hash_col))
    )
    return (
        starts.drop("_before")
        .withColumn("valid_to", F.lead(batch).over(per_key))
        .withColumnRenamed(batch, "valid_from")
    )


def latest_batch(df: DataFrame, stamp: str) -> DataFrame:
    """Rows of the newest batch; the maximum is a scalar subquery, not a round trip."""
    return df.filter(F.col(stamp) == df.agg(F.max(stamp)).scalar())
