"""Removing repeated passages, found by difference-cover anchors.

A window of ``WIDTH`` words whose word sequence also starts earlier (in a smaller id, or earlier in the same document) is
repeated; every word that a repeated window covers is removed. Not all windows are compared: short windows of ``ANCHOR``
words are hashed at the positions whose remainder modulo ``PERIOD`` lies in ``COVER``. Every difference modulo the period is a
difference of two members of the cover, so two equal windows share an anchor at the same place of both, within their first
PERIOD positions, and ``PERIOD - 1 + ANCHOR = WIDTH`` keeps it inside. Only windows around an anchor that other blocks have too
are extended to full windows and compared with those.

Documents are held in blocks (see blocks.py). Within a block windows are compared directly; between blocks
by hashes of 64 bits in buckets: the least id that has a window wins. Rows that repeat an id are told apart by block and place.
A null id counts as greater than all others. Null and empty texts, and texts shorter than a window, keep all words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from mercato.llm.blocks import BLOCK_BYTES, blocks, bucket_count, pack_any, pack_sorted, unpack, unpack_any, unpack_sorted
from mercato.llm.tables import widened
from mercato.llm.text import WordHashes, mixed, payloads

WIDTH, PERIOD, ANCHOR = 20, 13, 8
COVER = (0, 1, 3, 9)
LAST = 2**63 - 1


class Words:
    """The words of a block, one after the other in the order of the ids."""

    def __init__(self, batch: pa.RecordBatch):
        ids = batch["doc_id"].to_pylist()
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
        texts = payloads(batch["text"])
        self.words = [texts[k].split() for k in self.order]
        self.ids = np.array([LAST if ids[k] is None else ids[k] for k in self.order], np.int64)
        self.counts = np.array([len(x) for x in self.words], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        known = WordHashes()
        self.hashes = np.concatenate([known.of(x) for x in self.words]) if len(ids) else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(ids)), self.counts)
        self.place = np.arange(len(self.hashes)) - self.starts[self.doc]

    def windows(self, width: int) -> np.ndarray:
        """A hash of the ``width`` words from each position; only positions of ``inside(width)`` mean anything."""
        n = len(self.hashes)
        factor = np.uint64(0x9E3779B97F4A7C15)
        back = np.uint64(pow(int(factor), -1, 2**64))
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, back)]))
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, factor)]))
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes * down[:n])])
        ends = np.minimum(np.arange(n) + width, n)
        return mixed((total[ends] - total[:n]) * up[:n])

    def inside(self, width: int) -> np.ndarray:
        return self.place + width <= self.counts[self.doc]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes."""
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & self.inside(ANCHOR) & (self.counts >= WIDTH)[self.doc])
        return at, self.windows(ANCHOR)[at]


def _asks(block: int, hashes: np.ndarray, docs: np.ndarray | None, bits: int) -> Iterator[dict]:
    """Rows of distinct hashes, sorted, by bucket: the upper bits."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, z in zip(edges[:-1], edges[1:]):
        row = {"bucket": int(bucket[a]), "block": block, "hashes": pack_sorted(hashes[a:z])}
        yield row | ({"docs": pack_any(docs[a:z])} if docs is not None else {})


def _answers(block: np.ndarray, hashes: np.ndarray) -> pa.Table:
    """A row of sorted hashes per block; rows come grouped by block."""
    edges = [*np.flatnonzero(np.diff(block, prepend=-1)), len(block)] if len(block) else [0]
    rows = [(int(block[a]), pack_sorted(np.sort(hashes[a:z]))) for a, z in zip(edges[:-1], edges[1:])]
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "hashes": pa.array([r[1] for r in rows], pa.binary())})


def _heard(table: pa.Table) -> np.ndarray:
    parts = [unpack_sorted(x) for x in table["hashes"].to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _joined_asks(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack_sorted(x) for x in table["hashes"].to_pylist()]
    block = np.repeat(table["block"].to_numpy(), [len(x) for x in parts])
    return block, np.concatenate(parts)


def shared_anchors(table: pa.Table) -> pa.Table:
    """A bucket's hashes that more than one block asked for, to each of these."""
    block, hashes = _joined_asks(table)
    order = np.lexsort((block, hashes))
    block, hashes = block[order], hashes[order]
    same = hashes[1:] == hashes[:-1]
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    block, hashes = block[twice], hashes[twice]
    order = np.argsort(block, kind="stable")
    return _answers(block[order], hashes[order])


def earlier_windows(table: pa.Table) -> pa.Table:
    """A bucket's hashes to each block, unless that block has the least (id, block) of them."""
    block, hashes = _joined_asks(table)
    docs = np.concatenate([unpack_any(x) for x in table["docs"].to_pylist()]).view(np.int64)
    order = np.lexsort((block, docs, hashes))
    block, hashes = block[order], hashes[order]
    later = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    block, hashes = block[later], hashes[later]
    order = np.argsort(block, kind="stable")
    return _answers(block[order], hashes[order])


def removed_words(words: Words, elsewhere: np.ndarray) -> np.ndarray:
    """Which words of a block go: ``elsewhere`` are windows that another block has earlier."""
    at = np.flatnonzero(words.inside(WIDTH))
    own = words.windows(WIDTH)[at]
    order = np.argsort(own, kind="stable")
    again = np.zeros(len(at), bool)
    again[order[1:]] = own[order[1:]] == own[order[:-1]]
    again |= _member(own, elsewhere)
    edge = np.zeros(len(words.hashes) + 1, np.int64)
    edge[at[again]] += 1
    edge[at[again] + WIDTH] -= 1
    return np.cumsum(edge[:-1]) > 0


def dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space) added."""
    docs = docs.drop("n_words", "n_removed", "kept_text")
    stored = blocks(docs, name="anchor-blocks", most_bytes=block_bytes)
    bits = bucket_count(stored).bit_length() - 1
    schema = widened(docs, n_words=LongType(), n_removed=LongType(), kept_text=StringType())

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, content in zip(batch["block"].to_pylist(), batch["content"].to_pylist()):
                rows = list(_asks(block, np.unique(Words(unpack(content)).anchors()[1]), None, bits))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)

    def ask_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"bucket": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "hashes": pa.array([], pa.binary()), "docs": pa.array([], pa.binary())})
        if not left.num_rows or not right.num_rows:
            return empty
        words = Words(unpack(left["content"][0].as_py()))
        at, hashes = words.anchors()
        at = at[_member(hashes, _heard(right))]
        # extend: every window that holds a shared anchor
        edge = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(edge, np.maximum(at - (WIDTH - ANCHOR), words.starts[words.doc[at]]), 1)
        np.add.at(edge, at + 1, -1)
        at = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & words.inside(WIDTH))
        values, first = np.unique(words.windows(WIDTH)[at], return_index=True)
        rows = list(_asks(left["block"][0].as_py(), values, words.ids[words.doc[at[first]]].view(np.uint64), bits))
        return pa.Table.from_pylist(rows, empty.schema) if rows else empty

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        batch = unpack(left["content"][0].as_py())
        words = Words(batch)
        gone = removed_words(words, _heard(right))
        keep, n = [""] * len(words.order), np.zeros((2, len(words.order)), np.int64)
        for k, place in enumerate(words.order):
            a, own = words.starts[k], words.words[k]
            off = gone[a : a + len(own)]
            keep[place] = b" ".join(w for w, x in zip(own, off.tolist()) if not x) if off.any() else b" ".join(own)
            n[:, place] = len(own), off.sum()
        kept = pa.array(keep, pa.binary()).cast(pa.string())
        return pa.table([*batch.columns, pa.array(n[0]), pa.array(n[1]), kept], [*batch.schema.names, "n_words", "n_removed", "kept_text"])

    asked = stored.mapInArrow(ask_anchors, "bucket bigint, block bigint, hashes binary")
    shared = asked.groupBy("bucket").applyInArrow(shared_anchors, "block bigint, hashes binary")
    windows = stored.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        ask_windows, "bucket bigint, block bigint, hashes binary, docs binary"
    )
    earlier = windows.groupBy("bucket").applyInArrow(earlier_windows, "block bigint, hashes binary")
    return stored.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(finish, schema)


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
