"""N-gram Jaccard self-join by prefix filters under several global orders of the shingles.

Two sets of similarity t or more share a shingle among the first n - ceil(t n) + 1 of each, whatever the order, as long as
it is the same for all sets. So a pair must pass this test under every one of three orders; pairs are looked up by the prefixes of
the first order, must overlap in those of the two others, and are then verified on the whole texts. All orders put the most
frequent shingles of the corpus last and differ by seeded hashes among equals; what is right does not depend on the frequencies.

Texts with equal sets are one node. A first round tests each node of a prefix list against the list's least node, which joins
groups of near copies without listing their pairs; a second round tests every pair of a list that is not yet in
one component and may be similar by its sizes and parities. So no link between components is missed and no pair inside a component of copies is spelled out.
A pair that stands in many lists is made in few of them: a list leaves it to an earlier one if it sees among the last ``EARLIER`` lists of each node one of both.

Words are lower-case (A-Z) runs of non-blanks; a set holds the distinct shingles of ``width`` words (3 unless asked for), or the
whole sequence if there are fewer words.
Null texts and texts without words have empty sets and link with nothing. Rows that repeat an id are one document: linked. A
row with a null id is counted, but has no links and no component."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.links import components
from mercato.llm.tables import lookup
from mercato.llm.text import WordHashes, mixed, payloads, rows, window_hashes
from mercato.sources.tables import stage, unstage

WIDTH = 3
#: Similarity in hundredths.
LEAST = 90
#: Shingles are counted in this many bits of their hash.
SKETCH_BITS = 22
SEEDS = (0x51F2C3, 0xA7719B, 0x3D08E5)
PARITY_SEED = 0x6E1D27
#: Ids of texts to verify that are sent to all tasks; more are joined by shuffle.
BROADCAST_IDS = 500_000
#: Lists that a node was in before this one, which an entry of a list carries.
EARLIER = 8


def shingles(text: bytes, known: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    words = known.of(text.lower().split())
    return np.unique(window_hashes(words, min(width, len(words)))) if len(words) else np.empty(0, np.uint64)


def least_overlap(n: int, least: int = LEAST) -> int:
    return -(-least * n // 100)


def prefix(values: np.ndarray, rank: np.ndarray, seed: int, least: int = LEAST) -> np.ndarray:
    """First shingles of a set by (rank, seeded hash)."""
    size = len(values) - least_overlap(len(values), least) + 1
    key = (rank.astype(np.uint64) << np.uint64(56)) | (mixed(values ^ np.uint64(seed)) >> np.uint64(8))
    return values[np.argpartition(key, size - 1)[:size]]


def frequency_ranks(docs: DataFrame, bits: int = SKETCH_BITS, width: int = WIDTH) -> np.ndarray:
    """How frequent shingles are in all texts: the leading bits of a shingle choose one of ``2 ** bits`` counters, shared by what falls on
    it; a rank is four times the binary logarithm of a count. The counters are of a fixed size and travel compressed."""
    span = 2 ** min(bits, 17)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = WordHashes(), np.zeros(2**bits, np.uint32)
        for b in rows(batches):
            parts = [shingles(x, known, width) for x in payloads(b["text"])]
            if parts:
                np.add.at(total, (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
        for k in range(0, 2**bits, span):
            body = zstandard.ZstdCompressor(level=1).compress(total[k : k + span].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([body], pa.binary())], ["start", "body"])

    def plain(body: bytes) -> np.ndarray:
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(4, -1)
        return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)

    def ranked(table: pa.Table) -> pa.Table:
        total = sum(plain(x) for x in table["body"].to_pylist())
        body = np.minimum(np.floor(4 * np.log2(total + 1)), 255).astype(np.uint8).tobytes()
        return pa.table({"start": pa.array([table["start"][0].as_py()], pa.int64()), "ranks": pa.array([body], pa.binary())})

    parts = docs.select("text").mapInArrow(counted, "start bigint, body binary").groupBy("start").applyInArrow(ranked, "start bigint, ranks binary")
    ranks = np.zeros(2**bits, np.uint8)
    for r in parts.collect():  # 2**bits bytes together
        ranks[r.start : r.start + span] = np.frombuffer(r.ranks, np.uint8)
    return ranks


def sets(docs: DataFrame, ranks: np.ndarray, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """doc_id, n, set_key (null: empty set), the prefixes p1, p2, p3 (the last two in 16 bits), and the parities of 256 parts of the set
    as four integers: sets that differ in d shingles differ in at most d parities."""
    bits = len(ranks).bit_length() - 1

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in rows(batches):
            n, keys, found, odd = [], [], ([], [], []), []
            for text in payloads(b["text"]):
                own = shingles(text, known, width)
                n.append(len(own))
                keys.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                parts = np.bincount((mixed(own ^ np.uint64(PARITY_SEED)) >> np.uint64(56)).astype(np.int64), minlength=256)
                odd.append(np.packbits((parts & 1).astype(bool)).view(np.int64))
                rank = ranks[(own >> np.uint64(64 - bits)).astype(np.int64)]
                for k, seed in enumerate(SEEDS):
                    first = prefix(own, rank, seed, least) if len(own) else own
                    found[k].append(first.view(np.int64) if k == 0 else np.unique(first >> np.uint64(48)).astype(np.uint16).view(np.int16))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(found[0], pa.list_(pa.int64())),
                 *[pa.array(x, pa.list_(pa.int16())) for x in found[1:]], pa.array(odd, pa.list_(pa.int64()))],
                ["doc_id", "n", "set_key", "p1", "p2", "p3", "odd"],
            )

    schema = "doc_id bigint, n bigint, set_key binary, p1 array<bigint>, p2 array<smallint>, p3 array<smallint>, odd array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(made, schema)


def may_be_similar(n_a: str, odd_a: str, n_b: str, odd_b: str, least: int = LEAST) -> Column:
    """False only for sets too different: by their sizes, or by d parities that differ, as (1 + t) d <= (1 - t) (n_a + n_b) for
    similarity t."""
    d = sum((F.bit_count(F.get(odd_a, F.lit(k)).bitwiseXOR(F.get(odd_b, F.lit(k)))) for k in range(4)), F.lit(0))
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * least
    return sizes & ((100 + least) * d <= (100 - least) * (F.col(n_a) + F.col(n_b)))


def beside(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with columns of both their nodes, named with the side."""
    for x in "ab":
        pairs = pairs.join(nodes.select(F.col("doc_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns]), x)
    return pairs


def filtered(pairs: DataFrame, nodes: DataFrame, least: int = LEAST) -> DataFrame:
    """Pairs (a, b) that may be similar and overlap in the prefixes of the second and third order. Sizes and parities come first: they are
    short, and few pairs are left that the prefixes must be sent for."""
    few = beside(pairs, nodes, ["n", "odd"]).filter(may_be_similar("n_a", "odd_a", "n_b", "odd_b", least)).select("a", "b").distinct()
    both = beside(few, nodes, ["p2", "p3"])
    return both.filter(F.arrays_overlap("p2_a", "p2_b") & F.arrays_overlap("p3_a", "p3_b")).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """Pairs (a, b) whose texts' sets are similar. Texts travel compressed, those of the pairs only."""
    pairs = stage(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in rows(batches):
            body = pa.array([pack.compress(x) for x in payloads(b["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"], body], ["doc_id", "body"])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, unpack = WordHashes(), zstandard.ZstdDecompressor()
        last: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
        for b in rows(batches):
            good = []
            for x, y in zip(b["body_a"].to_pylist(), b["body_b"].to_pylist()):
                if x != last[0]:
                    last = (x, shingles(unpack.decompress(x), known, width))
                own = shingles(unpack.decompress(y), known, width)
                both = len(np.intersect1d(last[1], own, assume_unique=True))
                good.append(both > 0 and 100 * both >= least * (len(own) + len(last[1]) - both))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    texts = docs.select("doc_id", "text").join(lookup(wanted, BROADCAST_IDS), "doc_id", "left_semi").mapInArrow(packed, "doc_id bigint, body binary")
    held = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("body").alias("body_b")), "b")
    held = held.join(texts.select(F.col("doc_id").alias("a"), F.col("body").alias("body_a")), "a")
    return held.mapInArrow(similar, "a bigint, b bigint").distinct()


def with_earlier(some: DataFrame) -> DataFrame:
    """Entries (t, d) of lists with the last ``EARLIER`` lists before t that d is in."""
    before = F.collect_list("t").over(Window.partitionBy("d").orderBy("t").rowsBetween(-EARLIER, -1))
    return some.withColumn("before", before).withColumn("before", F.array_remove("before", F.col("t")))  # sets of one id may share t


def apart_pairs(some: DataFrame, least: int = LEAST) -> DataFrame:
    """Pairs (a, b) of one list that have different components and may be similar. A list does not make a pair if both entries carry
    one earlier list: that one has the pair too, whatever its main component is, because one of the two is not of it. The first list
    of both leaves it to none."""
    other = some.filter("c <> main").select(*[F.col(x).alias(f"{x}1") for x in ("t", "d", "c", "n", "odd", "before")])
    apart = F.expr("c <> c1 and (c = main or d1 < d)") & may_be_similar("n", "odd", "n1", "odd1", least)
    pairs = other.join(some, (F.col("t1") == F.col("t")) & apart & ~F.arrays_overlap("before", "before1"))
    return pairs.select(F.least("d", "d1").alias("a"), F.greatest("d", "d1").alias("b"))


def join(docs: DataFrame, ranks: np.ndarray | None = None, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row. Sets of ``width`` words; links from a similarity of ``least`` hundredths."""
    ranks = frequency_ranks(docs, width=width) if ranks is None else ranks
    every = stage(sets(docs, ranks, width, least), "shingle-sets")
    rows_ = stage(every.select("doc_id", "n", "set_key"), "set-keys")
    node = F.struct("doc_id", "n", "p1", "p2", "p3", "odd")
    reps = every.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min(node).alias("x"))
    nodes = stage(reps.select("set_key", "x.*"), "shingle-nodes")
    unstage(every)

    listed = nodes.select(F.col("doc_id").alias("d"), F.explode("p1").alias("t"))
    hubs = listed.groupBy("t").agg(F.min("d").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("t", "hub")
    live = stage(listed.join(hubs, "t"), "prefix-lists")

    first = live.filter("d <> hub").select(F.col("hub").alias("a"), F.col("d").alias("b")).distinct()
    links = stage(verified(filtered(first, nodes, least), docs, width, least), "links-1")

    # the second round: lists whose nodes are not all in one component yet
    found = components(links)
    known = live.join(found.select(F.col("node").alias("d"), "component"), "d", "left")
    known = stage(known.select("t", "d", "hub", F.coalesce("component", "d").alias("c")), "prefix-components")
    split = known.groupBy("t").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("t")
    open_ = known.join(split, "t").filter("d <> hub")
    main = open_.groupBy("t").agg(F.mode("c", True).alias("main"))
    size = nodes.select(F.col("doc_id").alias("d"), "n", "odd")
    some = stage(with_earlier(open_.join(main, "t").join(size, "d").select("t", "d", "c", "main", "n", "odd")), "open-lists")
    second = apart_pairs(some, least).distinct()
    more = stage(verified(filtered(second, nodes, least), docs, width, least), "links-2")

    # rows that repeat an id with other words link that id's sets
    final = components(links.unionByName(more)) if not more.isEmpty() else found
    part = nodes.select("set_key", "doc_id").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    part = part.select("set_key", F.coalesce("component", "doc_id").alias("component_id"))
    unstage(live, known, some)
    return rows_.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(part, "set_key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
