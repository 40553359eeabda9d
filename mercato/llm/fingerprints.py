"""Document fingerprints: a digest of bucket quartiles, and a bounded difference of two digests.

Every run of three bytes of a text, with two zero bytes before and behind it, is hashed to one of ``BUCKETS`` buckets. The
three quartiles of the bucket counts cut them into four classes; two bits per bucket say in which class it is, so the digest
tells what is frequent in a text, not how often it is. A first byte has the length on a scale of eight steps per doubling.
Two digests differ by the sum of the distances of their classes (0 to 3 each) and of their lengths (0 to ``LENGTH_STEPS``, each step as
``LENGTH_WEIGHT``); likeness is 1 less the share of the greatest difference, 1 for equal digests, never below 0.

``neighbours`` pairs each document with the next one by id, without a global sort: bounds are drawn from a sample of at most
``MOST_BUCKETS`` * ``DRAWS`` keys, each bound is itself a row, the first of its bucket, and a copy of it closes the bucket before. So one
shuffle of the texts is enough, buckets are sorted each by itself, and the sample moves only where a bucket ends, never a
result. Rows of one id are ordered by a hash of their text, so an id (or null, which comes first) that many rows have is cut into
buckets too; rows equal in both are interchangeable.

Null texts count as empty; an empty text has a fingerprint of its own. Repeated rows follow each other. An only row is followed by itself; other
columns are kept by ``fingerprints`` (one of that name is replaced) and not read by ``neighbours``. A task holds two texts at a time beside its batch."""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mercato.llm.tables import widened
from mercato.llm.text import rows

BUCKETS = 1024
LENGTH_STEPS, LENGTH_WEIGHT = 16, 21
GREATEST = 3 * BUCKETS + LENGTH_STEPS * LENGTH_WEIGHT
ROWS_PER_BUCKET, DRAWS, MOST_BUCKETS, STRIDE = 500, 20, 4_096, 64

NEIGHBOURS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def classes(data: bytes) -> tuple[int, np.ndarray]:
    """Length on its scale, and the class (0 to 3) of each bucket."""
    b = np.frombuffer(b"\0\0" + data + b"\0\0", np.uint8).astype(np.uint32)
    three = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    counts = np.bincount((three * np.uint32(2654435761)) >> np.uint32(22), minlength=BUCKETS)
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    return min(255, int(8 * np.log2(len(data) + 1))), (counts[:, None] > cuts).sum(1, dtype=np.uint8)


def written(length: int, own: np.ndarray) -> str:
    """Two hex digits of length, then one for every two buckets."""
    half = own[0::2] * 4 + own[1::2]
    return bytes([length]).hex() + (half[0::2] * 16 + half[1::2]).tobytes().hex()


def read(fingerprint: str) -> tuple[int, np.ndarray]:
    data = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return int(data[0]), ((data[1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).reshape(-1)


def alike(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Likeness of two digests as ``classes`` or ``read`` gives them."""
    apart = int(np.abs(a[1].astype(np.int8) - b[1].astype(np.int8)).sum())
    return 1 - (apart + LENGTH_WEIGHT * min(abs(a[0] - b[0]), LENGTH_STEPS)) / GREATEST


def likeness(a: str, b: str) -> float:
    """0 to 1 from two fingerprints."""
    return alike(read(a), read(b))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``fingerprint`` added. No shuffle."""
    docs = docs.drop("fingerprint")
    schema = widened(docs, fingerprint=StringType())

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            got = [written(*classes((x or "").encode())) for x in b[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], [*b.schema.names, "fingerprint"])

    return docs.mapInArrow(mapped, schema)


def bucket(bounds: np.ndarray) -> Column:
    """The number of the last bound (sorted pairs) that is not after (own, mark): first among every ``STRIDE``-th bound, then behind that."""
    pair = "struct<own: bigint, mark: bigint>"
    as_array = lambda rows: F.from_json(F.lit(json.dumps([{"own": int(a), "mark": int(b)} for a, b in rows])), f"array<{pair}>")
    key = F.struct(F.col("own").alias("own"), F.col("mark").alias("mark"))
    coarse = F.size(F.filter(as_array(bounds[::STRIDE]), lambda x: x <= key)) - 1
    fine = F.slice(as_array(bounds), coarse * STRIDE + 1, F.lit(STRIDE))
    return (coarse * STRIDE + F.size(F.filter(fine, lambda x: x <= key)) - 1).cast("bigint")


def sorted_bounds(keys: DataFrame) -> np.ndarray:
    """(own, mark) rows of the data: the first of all, and quantiles of a sample bounded by ``MOST_BUCKETS`` * ``DRAWS``."""
    first = keys.agg(F.min(F.struct("own", "mark")).alias("x")).select("x.*").first()
    n = min(MOST_BUCKETS, keys.count() // ROWS_PER_BUCKET + 1)
    drawn = keys.orderBy(F.xxhash64("own", "mark", F.lit(12)), "own", "mark").limit(n * DRAWS).toArrow()
    if first.own is None:
        return np.empty((0, 2), np.int64)
    drawn = sorted(zip(drawn["own"].to_pylist(), drawn["mark"].to_pylist()))
    return np.array(sorted({tuple(first), *drawn[DRAWS::DRAWS]}), np.int64).reshape(-1, 2)


def followed(docs: DataFrame) -> DataFrame:
    """(bucket, closes, own, mark, doc_id, text) in order of bucket, closes, own, mark inside a task: each row but a closing one is
    followed by the next document, that of a bucket's last row by the copy that closes the bucket."""
    keyed = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own: Column = F.coalesce("doc_id", F.lit(-(2**63)).cast("bigint"))
    keyed = keyed.withColumns({"own": own, "mark": F.xxhash64("text")})
    bounds = sorted_bounds(keyed.select("own", "mark"))
    placed = keyed.withColumn("bucket", bucket(bounds))
    # at most MOST_BUCKETS pairs of numbers; equal rows of a bound count once
    heads = [(int(a), int(b), (k - 1) % len(bounds)) for k, (a, b) in enumerate(bounds)]
    heads = docs.sparkSession.createDataFrame(heads, "own bigint, mark bigint, bucket bigint")
    closing = keyed.join(F.broadcast(heads), ["own", "mark"]).dropDuplicates(["own", "mark"])
    columns = ["bucket", "closes", "own", "mark", "doc_id", "text"]
    both = placed.withColumn("closes", F.lit(0)).select(*columns).unionByName(closing.withColumn("closes", F.lit(1)).select(*columns))
    return both.repartition("bucket").sortWithinPartitions("bucket", "closes", "own", "mark")


def neighbours(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its text with the last half replaced by the beginning of the next document's, as much of
    it as there is, and the likeness of its fingerprint to both: the edited text's and the next document's."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in rows(batches):
            out = []
            for doc_id, text, closes in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["closes"].to_pylist()):
                own = classes(text.encode())
                if last:
                    before, old, digest = last
                    cut = len(old) // 2
                    edited = (old[: len(old) - cut] + text[:cut]).encode()
                    changed = classes(edited)
                    out.append((before, len(old), sha256(edited).hexdigest(), written(*digest), written(*changed), alike(digest, changed), alike(digest, own)))
                last = None if closes else (doc_id, text, own)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = list(zip(*out)) or [()] * len(kinds)
            names = [x.split()[0] for x in NEIGHBOURS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)

    return followed(docs).select("doc_id", "text", "closes").mapInArrow(paired, NEIGHBOURS)
