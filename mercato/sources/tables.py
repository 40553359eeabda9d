"""Catalog tables: creating them, staging, and replacing their contents.

Tables of rows that change by key (``id``) are cut into hash buckets: ``bucket``, the partition column, is the bucket that Spark's own
bucketing gives the id, and each partition is clustered by id into that one bucket. So an upsert reads and rewrites the buckets of its keys
only, and a read of the table joins on id without an exchange. Closed versions of a history lie in the partition of the time that closed
them, batches of a silver table in a partition each.

Nothing is overwritten in place. New files are written beside the old ones; then partitions are pointed at them. Where several tables change
together, the list of pointers is written down first and a run that dies while it sets them is finished by the next one
(``recover``): before that point nothing of it is seen, after it all. One job at a time writes a table; row-level formats
have their own transactions."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato import schemas
from mercato.operators import merge, quality
from mercato.session import staging_dir

CLOSED_RUN, TOLD_RUN, BATCH, BUCKET = "closed_run", "told_run", "batch", "bucket"
LAYOUT = (CLOSED_RUN, TOLD_RUN, BATCH, BUCKET)
RUN_FORMAT = "yyyy-MM-dd'T'HHmmss.SSSSSS"  # no character that a path would escape
ROW_LEVEL_PROVIDERS = {"delta", "iceberg", "hudi"}
#: Buckets of a keyed table unless asked for others: about 200 MB each at the size it will have.
BUCKETS = 16
#: Table property that names the list of pointers of a run that is about to set them.
PLAN = "mercato.plan"
#: Of parquet files: half the size of Spark's default where most of a row is the hexadecimal text of a hash.
CODEC = "zstd"


# -- creating


def _keyed(spark: SparkSession, table: str, ddl: str, provider: str, buckets: int, comment: str = "") -> None:
    layout = "" if provider in ROW_LEVEL_PROVIDERS else f"PARTITIONED BY ({BUCKET}) CLUSTERED BY (id) INTO {buckets} BUCKETS"
    column = f", {BUCKET} int" if layout else ""
    comment = comment.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}{column}) USING {provider} {layout} COMMENT '{comment}'")


def create_silver(spark: SparkSession, schema: str = "silver", provider: str = "parquet", buckets: int = BUCKETS) -> None:
    """The silver tables: dictionaries; listings as they are now, and as they came, one partition per batch; what ingests rejected."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name, ddl in schemas.SILVER.items():
        if schemas.SILVER_KEYS[name] == ["id"]:
            _keyed(spark, f"{schema}.{name}", ddl, provider, buckets)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name}_batches ({ddl}, {BATCH} string) USING {provider} PARTITIONED BY ({BATCH})")
        else:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({ddl}) USING {provider}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {schema}.rejects ({schemas.REJECTS}, {BATCH} string) USING {provider} PARTITIONED BY ({BATCH})"
    )


def create_dimension(
    spark: SparkSession, dimension: str, ddl: str, rules: Iterable[str] = (), provider: str = "parquet", buckets: int = BUCKETS
) -> None:
    """A history: its open versions, its closed versions by the run that closed them, a log of what each run told (id and hash, by run),
    and a view over the versions."""
    comment = "; ".join(f"CHECK ({rule})" for rule in rules)
    _keyed(spark, f"{dimension}_open", ddl, provider, buckets, comment)
    text = comment.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {dimension}_closed ({ddl}, {CLOSED_RUN} string) "
        f"USING {provider} PARTITIONED BY ({CLOSED_RUN}) COMMENT '{text}'"
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {dimension}_log (id bigint, hash string, {TOLD_RUN} string) USING {provider} PARTITIONED BY ({TOLD_RUN})")
    cols = ", ".join(schemas.columns(ddl))
    spark.sql(
        f"CREATE OR REPLACE VIEW {dimension} AS SELECT {cols} FROM {dimension}_open UNION ALL SELECT {cols} FROM {dimension}_closed"
    )


def create_gold(spark: SparkSession, schema: str = "gold", provider: str = "parquet", buckets: int = BUCKETS) -> None:
    """The listing table and the dimensions, with their CHECK rules as comments."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    _keyed(spark, f"{schema}.listing", schemas.LISTING, provider, buckets)
    for name, ddl in schemas.DIMENSIONS.items():
        create_dimension(spark, f"{schema}.{name}", ddl, schemas.CHECKS[name].values(), provider, buckets)


# -- reading


def rows(spark: SparkSession, table: str) -> DataFrame:
    """The table without the columns that only say where a row is kept."""
    return spark.table(table).drop(*LAYOUT)


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """Location, provider and number of buckets, as the catalog has them. What the catalog says is picked out here, not by a job, which would wait for
    those that move rows."""
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r.col_name: r.data_type for r in lines if r.col_name in ("Location", "Provider", "Num Buckets")}


def _provider(spark: SparkSession, table: str, layout: dict[str, str] | None = None) -> str:
    return (layout or described(spark, table)).get("Provider", "").lower()


def partitions(spark: SparkSession, table: str) -> list[str]:
    """Values of a table's one partition column, in order, from the catalog."""
    return sorted(r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def run_name(run: datetime | Column) -> Column:
    stamp = run if isinstance(run, Column) else F.lit(run)
    return F.date_format(stamp.cast("timestamp"), RUN_FORMAT)


def name_of(spark: SparkSession, run: datetime) -> str:
    return spark.sql("SELECT * FROM VALUES (1)").select(run_name(run)).collect()[0][0]  # of values, so that it takes no job


def batch_times(spark: SparkSession, table: str) -> list[datetime]:
    """Times of the batches of a silver table, in order, from the list of its partitions."""
    names = partitions(spark, f"{table}_batches")
    if not names:
        return []
    return [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(F.to_timestamp("n", RUN_FORMAT)).collect()]


def batch_rows(spark: SparkSession, table: str, run: datetime | None = None) -> DataFrame:
    """One batch of a silver table, the newest unless named: a filter on the partition column, so nothing else is read."""
    names = partitions(spark, f"{table}_batches")
    name = name_of(spark, run) if run else (names or [""])[-1]
    return spark.table(f"{table}_batches").filter(F.col(BATCH) == name).drop(BATCH)


# -- staging


def stage(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared staging folder and read back: several consumers prune its
    columns, and a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged frames (as ``stage`` returned them) that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            df._staged_at = None


# -- pointing tables at new files


@dataclass(frozen=True)
class Move:
    """A table's partition (all of it: empty) gets its files from a path; without a path the partition goes."""

    table: str
    partition: str
    path: str | None


def set_pointers(spark: SparkSession, moves: Sequence[Move]) -> None:
    """May be repeated: what is set already is set again. Partitions that a table has not yet come in one statement."""
    for name in dict.fromkeys(m.table for m in moves):
        own = [m for m in moves if m.table == name]
        held = set(partitions(spark, name)) if any(m.partition for m in own) else set()
        new = {}
        for m in own:
            if not m.partition:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{m.path}'")
            elif m.path is None:
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({m.partition})")
            elif m.partition.split("=", 1)[1].strip(" '") in held:
                spark.sql(f"ALTER TABLE {name} PARTITION ({m.partition}) SET LOCATION '{m.path}'")
            else:
                new[m.partition] = m.path
        if new:
            added = " ".join(f"PARTITION ({p}) LOCATION '{path}'" for p, path in new.items())
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        spark.catalog.refreshTable(name)


def commit(spark: SparkSession, moves: Sequence[Move], journal: str) -> None:
    """Set the pointers of several tables as one: the list is stored and named in a property of the journal's table before the first is set."""
    path = f"{_root(spark, journal)}/_plan={uuid.uuid4().hex}"
    if not moves:
        return
    spark.createDataFrame([asdict(m) for m in moves], "table string, partition string, path string").coalesce(1).write.json(path)
    spark.sql(f"ALTER TABLE {journal} SET TBLPROPERTIES ('{PLAN}' = '{path}')")
    set_pointers(spark, moves)
    spark.sql(f"ALTER TABLE {journal} UNSET TBLPROPERTIES IF EXISTS ('{PLAN}')")


def recover(spark: SparkSession, journal: str) -> bool:
    """Finish a run that died while it set pointers."""
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {journal}").collect()}.get(PLAN)
    if found is None:
        return False
    listed = spark.read.schema("table string, partition string, path string").json(found).collect()
    set_pointers(spark, [Move(r.table, r.partition or "", r.path) for r in listed])
    spark.sql(f"ALTER TABLE {journal} UNSET TBLPROPERTIES IF EXISTS ('{PLAN}')")
    return True


def _root(spark: SparkSession, table: str) -> str:
    return described(spark, table)["Location"].split("/_v=")[0]


def _as_stored(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table, of its types: a frame may have narrower ones, or none where all is NULL."""
    kinds = df.sparkSession.table(table).schema
    return df.select(*[F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).cast(f.dataType) for f in kinds])


def replace_contents(df: DataFrame, table: str, buckets: Sequence[int] | None = None, now: bool = True) -> list[Move]:
    """Write the new contents (of the named buckets, each of which has rows) beside the old and point the table at them. Readers see one or
    the other; the old files stay for whoever still reads them. ``now`` False: the pointers are returned, not set."""
    spark = df.sparkSession
    layout = described(spark, table)
    path = f"{layout['Location'].split('/_v=')[0]}/_v={uuid.uuid4().hex}"
    df = _as_stored(df, table)
    if buckets is None:
        df.write.option("compression", CODEC).parquet(path)
        moves = [Move(table, "", path)]
    else:
        n = int(layout["Num Buckets"])
        # a table over the new folder for as long as it is written, because only tables are written in buckets
        beside = f"{table.rpartition('.')[0] or 'default'}.new_{uuid.uuid4().hex}"
        df.write.partitionBy(BUCKET).bucketBy(n, "id").sortBy("id").option("path", path).option("compression", CODEC).format("parquet").saveAsTable(beside)
        spark.sql(f"DROP TABLE {beside}")
        moves = [Move(table, f"{BUCKET} = {b}", f"{path}/{BUCKET}={b}") for b in buckets]
    if now:
        set_pointers(spark, moves)
    return moves


def _overwrite_partitions(df: DataFrame, table: str, names: Sequence[str], now: bool = True) -> list[Move]:
    """Replace the named partitions of a table with one partition column by the rows of the frame, which all lie in them; one without rows
    goes."""
    spark = df.sparkSession
    column = spark.table(table).columns[-1]
    df = _as_stored(df, table)
    layout = described(spark, table)
    if _provider(spark, table, layout) in ROW_LEVEL_PROVIDERS:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)
        return []
    path = f"{layout['Location'].split('/_v=')[0]}/_v={uuid.uuid4().hex}"
    if len(names) == 1:
        moves = [_partition_written(df.drop(column), table, column, names[0], path)]
    else:
        df.write.partitionBy(column).option("compression", CODEC).parquet(path)
        held = {r[0] for r in spark.read.schema(df.schema).parquet(path).select(column).distinct().collect()}
        moves = [Move(table, f"{column} = '{n}'", f"{path}/{column}={n}" if n in held else None) for n in names]
    if now:
        set_pointers(spark, moves)
    return moves


def _partition_written(df: DataFrame, table: str, column: str, name: str, path: str) -> Move:
    """The rows of one partition written into its folder, where nothing has to be sorted by partition or looked up afterwards."""
    place = f"{path}/{column}={name}"
    df.write.option("compression", CODEC).parquet(place)
    rowless = df.sparkSession.read.schema(df.schema).parquet(place).isEmpty()
    return Move(table, f"{column} = '{name}'", None if rowless else place)


def append_batch(df: DataFrame, table: str, name: str) -> None:
    """Store a batch in the partition of its name; the same name again replaces it."""
    _overwrite_partitions(df.withColumn(BATCH, F.lit(name)), table, [name])


def stored_batch(df: DataFrame, table: str, name: str) -> DataFrame:
    """Store a batch as ``append_batch`` does, and return it as it is stored: it is written once."""
    spark = df.sparkSession
    layout = described(spark, table)
    if _provider(spark, table, layout) in ROW_LEVEL_PROVIDERS:
        kept = stage(df, "raw-batch")
        append_batch(kept, table, name)
        return kept
    df = _as_stored(df.withColumn(BATCH, F.lit(name)), table).drop(BATCH)
    path = f"{layout['Location'].split('/_v=')[0]}/_v={uuid.uuid4().hex}"
    set_pointers(spark, [_partition_written(df, table, BATCH, name, path)])
    return spark.read.schema(df.schema).parquet(f"{path}/{BATCH}={name}")


def require_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    """A batch that holds a key twice has no defined result, in any table format."""
    twice = batch.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1").limit(3).collect()
    if twice:
        raise ValueError(f"the batch holds keys more than once, for example {[tuple(r)[:-1] for r in twice]}")


def bucket_of(n: int) -> Column:
    """The bucket that Spark's bucketing gives an id."""
    return F.pmod(F.hash("id"), F.lit(n))


def touched_buckets(batch: DataFrame, n: int) -> list[int]:
    return sorted(r[0] for r in batch.select(bucket_of(n)).distinct().collect())


def unique_buckets(batch: DataFrame, n: int) -> list[int]:
    """``require_unique`` of the ids and ``touched_buckets`` in one pass over them."""
    counted = batch.groupBy("id").agg(F.count("*").alias("rows"))
    found = counted.agg(F.max("rows").alias("most"), F.collect_set(bucket_of(n)).alias("buckets")).first()
    if (found.most or 0) > 1:
        require_unique(batch, ["id"])
    return sorted(found.buckets)


def upsert_table(batch: DataFrame, table: str, keys: Sequence[str], now: bool = True, buckets: Sequence[int] | None = None) -> list[Move]:
    """Upsert a batch: MERGE where the table's format has row-level operations; a rewrite of the buckets that hold its keys where the table
    has buckets; of the whole table (a dictionary) elsewhere. A key that the batch holds twice is an error. ``buckets``: those of the batch,
    whose ids are known to be unique."""
    spark = batch.sparkSession
    layout = described(spark, table)
    n = int(layout.get("Num Buckets", 0))
    if buckets is None and n and list(keys) == ["id"]:
        buckets = unique_buckets(batch, n)
    elif buckets is None:
        require_unique(batch, keys)
    target = spark.table(table)
    if _provider(spark, table, layout) in ROW_LEVEL_PROVIDERS:
        same = " AND ".join(f"t.{k} = b.{k}" for k in keys)
        spark.sql(
            f"MERGE INTO {table} t USING {{batch}} b ON {same} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            batch=batch,
        )
        return []
    if not n:
        return replace_contents(merge.upsert(target, batch, keys), table, None, now)
    if buckets is None:
        buckets = touched_buckets(batch, n)
    if not buckets:
        return []
    if {str(b) for b in buckets}.isdisjoint(partitions(spark, table)):  # nothing is held there: the batch is what they get
        after = batch.withColumn(BUCKET, bucket_of(n)).repartition(n, "id")
    else:
        after = bucket_upsert(target, batch, buckets, n)
    return replace_contents(after, table, buckets, now)


def bucket_upsert(target: DataFrame, batch: DataFrame, buckets: Sequence[int], n: int) -> DataFrame:
    """The named buckets of a bucketed table after the batch. The table's side of the join is read in its buckets, without an exchange."""
    held = target.filter(F.col(BUCKET).isin(list(buckets)))
    return merge.replaced(held, batch.withColumn(BUCKET, bucket_of(n)), ["id"])


# -- history


def _observed(batch: DataFrame, dimension: str) -> tuple[DataFrame, Observation | None]:
    """The batch with the rules of its dimension counted on the way to wherever it is written."""
    name = dimension.split(".")[-1]
    if name not in schemas.DIMENSIONS:
        return batch, None
    required = [c for c in schemas.required(schemas.DIMENSIONS[name]) if c in batch.columns]
    rules = {k: x for k, x in schemas.CHECKS[name].items() if k != "valid_interval"}
    return quality.observed(batch, required, rules, name)


def _told(spark: SparkSession, dimension: str, since: str, ids: DataFrame) -> DataFrame:
    """(id, hash, valid_from) of what runs from a time on told of some ids, from the log."""
    log = spark.table(f"{dimension}_log").filter(F.col(TOLD_RUN) >= since).join(ids.hint("merge"), "id", "left_semi")
    return log.select("id", "hash", F.to_timestamp(TOLD_RUN, RUN_FORMAT).alias("valid_from"))


def apply_scd2(batch: DataFrame, dimension: str, run: datetime) -> dict[str, int]:
    """One run of a dimension: the states of some keys at a time. Runs may come in any order and at the same time; what was told
    and what comes are put in order of time, per key of which something is known (see merge.scd2_splice), so the history is that of all runs in their
    order. That takes a log of what each run told, because a state that only repeats the one before it leaves no version of its own, yet
    counts when a run between the two comes late. A state that contradicts one of its key at the very same time is an error.

    Only the buckets of open versions and the partitions of closed ones that change are written; a run that is later than all before it
    adds one partition of each and reads none. Broken rules (NOT NULL, CHECK), counted while the batch is staged, are an error before anything
    is stored. Returns these counts.

    What the catalog's lists of partitions show to be absent is not read, joined or staged. Ids are joined by a shuffle at any size: they are as
    many as the batch, but stored so small that Spark would take millions of them for a few MB and gather them on the driver."""
    spark = batch.sparkSession
    name = dimension.split(".")[-1]
    opened, closed, log = f"{dimension}_open", f"{dimension}_closed", f"{dimension}_log"
    recover(spark, opened)
    batch, counts = _observed(batch, dimension)
    states = stage(batch, name)
    seen = quality.require_rules(counts, dimension)
    layout, columns, here = described(spark, opened), rows(spark, opened).columns, name_of(spark, run)
    n = int(layout.get("Num Buckets", 0))
    if n:
        buckets = unique_buckets(states, n)
        runs = {kind: partitions(spark, kind) for kind in (opened, closed, log)}
    else:  # a format of its own keeps its partitions to itself
        require_unique(states, ["id"])
        buckets, runs = None, None

    def absent(kind: str, names: Iterable[str]) -> bool:
        return runs is not None and set(names).isdisjoint(runs[kind])

    def since(kind: str) -> list[str]:
        return [x for x in runs[kind] if x >= here] if runs else []

    at, ids = F.lit(run).cast("timestamp"), states.select("id").hint("merge")
    told = states.select("id", "hash", at.alias("valid_from")).limit(0)
    if not absent(log, since(log)):
        told = stage(_told(spark, dimension, here, ids), f"{name}-told")
        held = told.filter(F.col("valid_from") == at).select("id", F.col("hash").alias("_held")).hint("merge")
        contradicted = states.join(held, "id").filter("hash <> _held").select("id").first()
        if contradicted:
            raise ValueError(f"{dimension} has another state of id {contradicted.id} at {run}; a run that changes it must be later")

    current, late = spark.table(opened), spark.table(closed).filter(F.col(CLOSED_RUN) >= here)
    if n:
        current = current.filter(F.col(BUCKET).isin(buckets))
    stored = [
        versions.select(*columns).join(ids, "id", "left_semi")
        for versions, none in ((current, absent(opened, map(str, buckets or ()))), (late, absent(closed, since(closed)))) if not none
    ]
    stored = stage(reduce(DataFrame.unionByName, stored), f"{name}-stored") if stored else spark.table(opened).select(*columns).limit(0)
    # a key of which nothing is known opens a version, whatever the others do
    known = stored.select("id").unionByName(told.select("id")).hint("merge")
    new_states = states.withColumn("valid_from", at)
    fresh = new_states.withColumn("valid_to", F.lit(None).cast("timestamp")).select(*columns)
    again = new_states.limit(0)
    some = not known.isEmpty()
    if some:
        fresh, again = fresh.join(known, "id", "left_anti"), new_states.join(known, "id", "left_semi")
    content = stored.drop("valid_from", "valid_to").dropDuplicates(["id", "hash"]).hint("merge")  # a version's hash stands for its content
    confirmed = told.filter(F.col("valid_from") > at).join(content, ["id", "hash"]).select(*new_states.columns)
    after = merge.scd2_splice(stored, again.unionByName(confirmed), columns)
    changed = merge.scd2_changes(stored, after)
    changed = stage(changed, f"{name}-changes") if some else changed.limit(0)

    mine = new_states.select("id", "hash", F.lit(here).alias(TOLD_RUN))
    if not absent(log, [here]):
        others = spark.table(log).filter(F.col(TOLD_RUN) == here).join(ids, "id", "left_anti")
        mine = others.select(*mine.columns).unionByName(mine)
    moves = _overwrite_partitions(mine, log, [here], False)
    gone, new = changed.filter("gone").drop("gone"), changed.filter("not gone").drop("gone")
    ends = changed.filter("valid_to IS NOT NULL").select(run_name(F.col("valid_to")).alias("n")).distinct()
    names = sorted(r.n for r in ends.collect()) if some else []
    if names:
        ended = new.filter("valid_to IS NOT NULL").withColumn(CLOSED_RUN, run_name(F.col("valid_to")))
        if not absent(closed, names):
            keys = gone.select("id", "valid_from").hint("merge")
            kept = spark.table(closed).filter(F.col(CLOSED_RUN).isin(names)).join(keys, ["id", "valid_from"], "left_anti")
            ended = kept.unionByName(ended)
        moves += _overwrite_partitions(ended, closed, names, False)
    # unique, as the states are: the open one of the versions of a key, or the first
    opening = new.filter("valid_to IS NULL").unionByName(fresh) if some else fresh
    moves += upsert_table(opening, opened, ["id"], False, touched_buckets(opening, n) if some and n else buckets)
    commit(spark, moves, opened)
    unstage(states, told, stored, changed)
    return seen
