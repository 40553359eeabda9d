"""Mixing sources to target weights by Poisson replication.

A document of a source is taken as often as a Poisson variable with the source's repetition rate says: the
distribution function is inverted at a uniform number made from the id and a seed, so any run, order or
partitioning takes the same copies. Copies are spread by a hash over the whole result.

Rates: target share of a source times the number of all documents over those of the source. A null source
is a source of its own (''). Sources without a target share are not taken; targets are scaled to sum 1. Rows
that repeat an id are replicated alike. A null id is hashed like the text 'null'. The rate of a source that
has no rows plays no part; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import lookup

SEED = "mix-1"
#: Beyond this rate a copy count is the sum of whole parts of at most this rate: exp(-rate) stays exact.
PART = 16.0
TERMS = 80


def uniform(*parts: Column | str) -> Column:
    """In [0, 1), 52 bits of the MD5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def poisson(rate: Column, u: Column) -> Column:
    """Least k whose distribution function exceeds u; rate at most ``PART``, so that the ``TERMS`` summed
    terms reach 1 within double precision."""
    start = F.struct(F.lit(0).alias("k"), F.exp(-rate).alias("term"), F.exp(-rate).alias("total"))

    def step(s, i):
        term = s["term"] * rate / i
        more = F.struct((s["k"] + 1).alias("k"), term.alias("term"), (s["total"] + term).alias("total"))
        return F.when(s["total"] > u, s).otherwise(more)

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["k"]


def source_rates(docs: DataFrame, targets: Mapping[str, float] | None, power: float) -> DataFrame:
    """(source_key, rate), one row per source. Without targets a source's share goes by its number of
    documents to the ``power`` (1: as they are, 0: all alike)."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source_key")).agg(F.count(F.lit(1)).alias("rows"))
    if targets is None:
        share = F.pow(F.col("rows").cast("double"), F.lit(power))
    else:
        share = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])[F.col("source_key")] if targets else F.lit(0.0)
    shares = counts.select("source_key", "rows", F.coalesce(share, F.lit(0.0)).alias("share"))
    totals = shares.agg(F.sum("share").alias("all_shares"), F.sum("rows").alias("all_rows"))
    rate = F.col("share") / F.col("all_shares") * F.col("all_rows") / F.col("rows")
    # one row joins: no product of two tables
    return shares.join(F.broadcast(totals)).select("source_key", F.when(F.col("all_shares") > 0, rate).otherwise(0.0).alias("rate"))


def replicate(
    docs: DataFrame, targets: Mapping[str, float] | None = None, power: float = 0.5, seed: str = SEED
) -> DataFrame:
    """The rows, as often as drawn, with ``copy_no`` (from 1), ``rate`` and ``shuffle_key``: a row goes to
    a partition by the hash of its key and stands there in the order of the key. One shuffle of the copies taken."""
    docs = docs.drop("copy_no", "rate", "shuffle_key", "source_key")
    rates = source_rates(docs, targets, power)
    keyed = docs.withColumn("source_key", F.coalesce("source", F.lit(""))).join(lookup(rates), "source_key").drop("source_key")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))
    draws = F.transform(
        F.sequence(F.lit(1), parts),
        lambda p: poisson(F.col("rate") / parts, uniform(seed, F.col("doc_id"), p)),
    )
    count = F.aggregate(draws, F.lit(0), lambda a, x: a + x)
    drawn = keyed.withColumn("_copies", count).filter(F.col("_copies") > 0)
    copies = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")
    keyed = copies.withColumn("shuffle_key", uniform(seed, "place", F.col("doc_id"), F.col("copy_no")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy_no")
