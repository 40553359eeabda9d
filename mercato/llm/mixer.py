"""Scoring texts by online logistic context mixing.

A text is a sequence of words and one end; a word is its bytes and a blank, the end is a line feed. Two kinds of bits are predicted, each
by counters in several contexts whose log odds are mixed by weights that a gate chooses, learned online by logistic gradient steps.

* Is the next word one that the text has had? Contexts: how often that was so in this text until here (a counter that adapts along the text),
  the place in the text with the last three answers, and the word before. A word that the text has had is then drawn from its words so far.
* The bits of a new word, highest first. Contexts: the last one to four bytes with the bits of the byte so far, in hashed tables of a fixed size; and
  the whole word so far, counted exactly, so that what is gathered grows with the vocabulary. A table from the mixed odds to what really
  followed refines the result. The probability of words that the text has had already is shared out among the others.

The bits add up to the bits of the text, given as a logarithm to base 10 and as bits per byte.

Words are counted over all training texts, those whose crc32 of the id modulo 5 is not 1; a null id is neither held out nor
learned from. What a word costs as a new one does not depend on the text, so each distinct word is costed once: blocks of texts (see blocks.py) send their distinct words
to buckets (by their first ``PREFIX`` bytes, so that a bucket has all words that share longer beginnings), buckets count, learn and cost, and answer the
blocks, which go through the occurrences of their words, numbered when they asked, word by word. In learning, an occurrence is predicted by counts without itself.
Null and empty texts are one end. Repeated rows are counted and scored each. With nothing to learn from all counts are 0."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.blocks import blocks, bucket_count, pack_any, unpack, unpack_any
from mercato.llm.text import mixed, payloads
from mercato.sources.tables import stage

FOLDS, HELD_FOLD = 5, 1
BLOCK_BYTES = 8_000_000
#: Bytes of context and table bits of each hashed counter; the counters of the whole word so far come after these.
ORDERS = ((1, 16), (2, 18), (3, 20), (4, 21))
#: Words with the same first bytes are in one bucket; longer beginnings are counted exactly.
PREFIX = 4
INPUTS = len(ORDERS) + 2
PLACES = [0, *np.cumsum([2**b for _, b in ORDERS]).tolist()]
TABLE = PLACES[-1]
RANGE = 2**17
#: Gates: highest order with counts, size of these counts in four steps, place of the bit.
GATES, BINS = 32 * INPUTS, 33
#: Contexts of "had already": logarithm of the place with three answers, hash of the word before; gates: logarithm of the place.
PLACE_STEPS, BEFORE = 24, 1 << 12
HAD_CELLS, HAD_INPUTS = PLACE_STEPS * 8 + BEFORE, 4
HAD_STEP = 20_000
FEW = 0.2
STEP_WORDS = 256
RATE = 0.05
END = b"\n"


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


@dataclass
class Bits:
    """The bits of words: per counter the slot, the bit, and the number of its word."""

    slots: np.ndarray
    bit: np.ndarray
    word: np.ndarray
    #: How often the word so far was seen, and went on with the bit.
    seen: np.ndarray
    went: np.ndarray


def coded(word: bytes) -> bytes:
    return word if word == END else word + b" "


def beginnings(words: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bit of words in sorted order (as ``bits_of`` lays them out): the sum of times of the words that begin with the bits
    before it, and with these and the bit. Words that begin alike stand together, so a beginning is a run of them. Bits of the first
    ``PREFIX`` bytes, which words of other buckets share, have none."""
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    length = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(length) - length
    seen, went = (np.repeat(times.astype(np.float32), 8 * length) for _ in range(2))  # true of a word that begins like no other
    here, starts = np.arange(len(words)), np.zeros(len(words), bool)
    starts[:1] = True
    d = 0
    while len(here):
        byte = data[first[here] + d]
        sums, group = [], np.empty(0, np.int64)
        for b in range(9):
            opens = starts.copy()
            opens[1:] |= (byte[1:] >> (8 - b)) != (byte[:-1] >> (8 - b))
            group = np.cumsum(opens) - 1
            sums.append(np.add.reduceat(times[here], np.flatnonzero(opens))[group])
        at = 8 * (first[here] + d)
        for b in range(8):
            seen[at + b], went[at + b] = sums[b], sums[b + 1]
        d += 1
        more = (np.bincount(group)[group] > 1) & (length[here] > d)
        here, group = here[more], group[more]
        starts = np.ones(len(here), bool)
        starts[1:] = group[1:] != group[:-1]
    early = np.repeat(np.arange(len(data)) - np.repeat(first, length) < PREFIX, 8)
    seen[early] = went[early] = 0
    return seen, went


def bits_of(words: list[bytes], seen: np.ndarray | None = None, went: np.ndarray | None = None) -> Bits:
    """``seen`` and ``went``: of their beginnings; none if not given."""
    coded_words = [coded(w) for w in words]
    data = np.frombuffer(b"".join(coded_words), np.uint8).astype(np.uint64)
    length = np.array([len(w) for w in coded_words], np.int64)
    word = np.repeat(np.arange(len(coded_words)), length)
    place = np.arange(len(data)) - np.repeat(np.cumsum(length) - length, length)
    contexts, so_far, k = [], np.zeros(len(data), np.uint64), 0
    for order, _ in ORDERS:
        for k in range(k + 1, order + 1):
            back = np.where(place >= k, np.concatenate([np.zeros(min(k, len(data)), np.uint64), data[:-k]]) + np.uint64(1), np.uint64(0))
            so_far = so_far | (back << np.uint64(9 * (k - 1)))
        contexts.append(so_far.copy())
    partial = np.stack([(np.uint64(1) << np.uint64(b)) | (data >> np.uint64(8 - b)) for b in range(8)], 1)
    bit = np.stack([(data >> np.uint64(7 - b)) & np.uint64(1) for b in range(8)], 1).astype(np.int8)
    slots, spread = np.empty((len(ORDERS), 8 * len(data)), np.int64), partial * np.uint64(0xD6E8FEB86659FD93)
    for j, (order, size) in enumerate(ORDERS):
        key = mixed(contexts[j] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(order))[:, None] + spread
        slots[j] = (((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - size)).ravel()
        slots[j] += PLACES[j]
    none = np.zeros(8 * len(data), np.float32)
    return Bits(slots, bit.ravel(), np.repeat(word, 8), none if seen is None else seen, none if went is None else went)


@dataclass
class Model:
    counts: np.ndarray  # 2 x TABLE: zeros, ones
    weights: np.ndarray  # gates x inputs
    refined: np.ndarray  # gates x bins: probability of a one

    def inputs(self, b: Bits, without: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of the counters (and 0.3), and the gate of each bit; ``without``: leave out one occurrence of the bit itself."""
        zero, one = np.empty((2, len(ORDERS) + 1, len(b.bit)), np.float32)
        for k, slots in enumerate(b.slots):
            self.counts[0].take(slots, out=zero[k], mode="clip")  # slots are in range; anything else than "clip" would copy once more
            self.counts[1].take(slots, out=one[k], mode="clip")
        one[-1] = np.where(b.bit == 1, b.went, b.seen - b.went)
        zero[-1] = b.seen - one[-1]
        if without:
            one, zero = np.maximum(one - b.bit, 0), np.maximum(zero - (1 - b.bit), 0)
        odds = np.log((one + FEW) / (zero + FEW))
        both, top = zero + one, np.zeros(len(b.bit), np.int64)
        seen = both[0].copy()
        for k, n in enumerate(both, 1):
            top[n > 0] = k
            np.copyto(seen, n, where=n > 0)
        size = (seen >= 3).astype(np.int64) + (seen >= 20) + (seen >= 300)
        gate = (top * 4 + size) * 8 + np.tile(np.arange(8), len(b.bit) // 8)
        return np.vstack([odds, np.full(len(b.bit), 0.3, odds.dtype)]), gate

    def mix(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(len(gate))
        for own, weights in zip(odds, np.ascontiguousarray(self.weights.T)):
            total += own * weights[gate]
        return np.clip(total, -12, 12)

    def learn(self, b: Bits, times: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step for some words; ``steps``: squares of the gradients so far (AdaGrad). Returns its inputs."""
        odds, gate = self.inputs(b, True)
        error = (b.bit - 1 / (1 + np.exp(-self.mix(odds, gate)))) * times[b.word]
        total = np.maximum(np.bincount(gate, times[b.word], GATES), 1e-9)
        for k in range(odds.shape[0]):
            slope = np.bincount(gate, error * odds[k], GATES) / total
            steps[:, k] += slope * slope
            self.weights[:, k] += RATE * slope / np.sqrt(steps[:, k])
        return odds, gate

    def log10(self, words: list[bytes], seen: np.ndarray | None = None, went: np.ndarray | None = None) -> np.ndarray:
        b = bits_of(words, seen, went)
        odds, gate = self.inputs(b)
        z = self.mix(odds, gate)
        p = 1 / (1 + np.exp(-z))
        p = np.clip((p + self.refined[gate, bin_of(z)]) / 2, 1e-6, 1 - 1e-6)
        return np.bincount(b.word, np.log10(np.where(b.bit == 1, p, 1 - p)), len(words))


def bin_of(z: np.ndarray) -> np.ndarray:
    return np.rint((z + 12) * ((BINS - 1) / 24)).astype(np.int64)


@dataclass
class Words:
    """The words of a block: its distinct ones in the order of their buckets, and all occurrences, text behind text. What goes along
    the texts needs the last three only."""

    distinct: list[bytes]
    bucket: np.ndarray
    hashes: np.ndarray  # of the distinct ones, below BEFORE
    at: np.ndarray  # place among the distinct ones
    size: np.ndarray  # words of each text

    def packed(self, block: pa.RecordBatch) -> bytes:
        """The occurrences, and what is told of each text, without the texts."""
        n_bytes = np.array([len(x) for x in payloads(block["text"])], np.uint64)
        rows = pa.RecordBatch.from_arrays([block["doc_id"], block["held_out"]], ["doc_id", "held_out"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_batch(rows)
        numbers = [pack_any(x.astype(np.uint64)) for x in (n_bytes, self.size, self.hashes, self.at)]
        return pickle.dumps([zstandard.ZstdCompressor(level=1).compress(sink.getvalue()), *numbers])

    @staticmethod
    def unpacked(data: bytes) -> tuple[pa.RecordBatch, np.ndarray, Words]:
        rows, *numbers = pickle.loads(data)
        n_bytes, size, hashes, at = (unpack_any(x).astype(np.int64) for x in numbers)
        return unpack(rows), n_bytes, Words([], np.empty(0, np.int64), hashes, at, size)


def block_words(batch: pa.RecordBatch, bits: int) -> Words:
    texts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch["text"].cast(pa.large_string()), "")))
    found, text = texts.flatten(), pc.list_parent_indices(texts).to_numpy()
    some = pc.not_equal(pc.binary_length(found), 0)  # empty beside blanks at an end, or a text without words
    size = np.bincount(text[some.to_numpy(zero_copy_only=False)], minlength=len(texts))
    coded_words = found.filter(some).dictionary_encode()
    distinct = coded_words.dictionary.cast(pa.large_binary()).to_pylist()
    bucket = first_bytes(distinct) & ((1 << bits) - 1)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    distinct = [distinct[k] for k in order.tolist()]
    hashes = np.fromiter(map(crc32, distinct), np.int64, len(distinct)) & (BEFORE - 1)
    return Words(distinct, bucket[order], hashes, place[coded_words.indices.to_numpy()], size)


def first_bytes(words: list[bytes]) -> np.ndarray:
    """crc32 of the first ``PREFIX`` bytes of words as they are coded, taken once of each."""
    begun = [coded(w[:PREFIX])[:PREFIX] for w in words]
    known = {x: crc32(x) for x in set(begun)}
    return np.fromiter(map(known.__getitem__, begun), np.int64, len(begun))


@dataclass
class Repeats:
    """Of each word of some texts, text behind text: its place, how often the text had it before, how many words it had had before, and the
    cells of the contexts of "had already"."""

    text: np.ndarray
    place: np.ndarray
    times: np.ndarray
    before: np.ndarray
    cells: np.ndarray  # 2 x words

    @property
    def had(self) -> np.ndarray:
        return self.times > 0


def repeats(words: Words) -> Repeats:
    n, size = len(words.at), words.size
    first = np.cumsum(size) - size
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(n) - first[text]
    # text and word, and behind them the place: sorting numbers is faster than sorting places by them
    low = max(1, n.bit_length())
    key = np.sort(((text * max(1, len(words.hashes)) + words.at) << low) | np.arange(n))
    order, key = key & ((1 << low) - 1), key >> low
    opens = np.ones(n, bool)
    opens[1:] = key[1:] != key[:-1]
    run = np.flatnonzero(opens)
    times = np.empty(n, np.int64)
    times[order] = np.arange(n) - run[np.cumsum(opens) - 1] if n else 0
    had = (times > 0).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(had)])
    before = sums[:-1] - sums[first[text]] if n else had
    last = np.zeros(n, np.int64)
    for k in (1, 2, 3):
        last[k:] |= np.where(place[k:] >= k, had[:-k], 0) << (k - 1)
    previous = np.zeros(n, np.int64)
    previous[1:] = np.where(place[1:] > 0, words.hashes[words.at[:-1]], 0) if n else 0
    step = np.minimum(np.floor(np.log2(place + 1)).astype(np.int64), PLACE_STEPS - 1)
    return Repeats(text, place, times, before, np.stack([step * 8 + last, PLACE_STEPS * 8 + previous]))


@dataclass
class Had:
    """The model of "had already": counts of no and yes per cell, weights per gate."""

    counts: np.ndarray  # 2 x HAD_CELLS
    weights: np.ndarray  # PLACE_STEPS x HAD_INPUTS

    def inputs(self, r: Repeats, part: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        yes, place = r.before[part], r.place[part]
        cells = r.cells[:, part]
        odds = [np.log((yes + 0.5) / (place - yes + 0.5)), *np.log((self.counts[1][cells] + 0.5) / (self.counts[0][cells] + 0.5)), np.full(len(place), 0.3)]
        return np.stack(odds), cells[0] // 8

    def yes(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.einsum("kn,nk->n", odds, self.weights[gate]), -12, 12)))

    def learn(self, r: Repeats, learned: np.ndarray, steps: np.ndarray, used: np.ndarray) -> None:
        """Online over the words of the texts marked as learned: predict, step the weights (AdaGrad), then count."""
        keep = learned[r.text]
        r = Repeats(r.text[keep], r.place[keep], r.times[keep], r.before[keep], r.cells[:, keep])
        for k in range(0, len(r.place), HAD_STEP):
            part = slice(k, k + HAD_STEP)
            odds, gate = self.inputs(r, part)
            had, real = r.had[part], r.place[part] > 0  # the first word of a text cannot have been there
            error = (had - self.yes(odds, gate)) * real
            total = np.bincount(gate, real, PLACE_STEPS)
            for j in range(HAD_INPUTS):
                slope = np.bincount(gate, error * odds[j], PLACE_STEPS) / np.maximum(total, 1)
                steps[:, j] += slope * slope
                self.weights[:, j] += RATE * slope / np.sqrt(steps[:, j])
            used += total
            for cells in r.cells[:, part]:
                for x in (0, 1):
                    self.counts[x] += np.bincount(cells[real & (had == x)], minlength=HAD_CELLS)

    def log10(self, r: Repeats, words: Words, value: np.ndarray, end: float) -> np.ndarray:
        """Of each text; ``value``: log10 of each distinct word as a new one, ``end``: of the end."""
        size, new = words.size, value[words.at]
        yes = np.where(r.place > 0, self.yes(*self.inputs(r)), 0.0)
        had = r.had
        # what new words of the text have taken so far is no longer theirs to take
        taken = np.concatenate([[0.0], np.cumsum(np.where(had, 0.0, (10.0**value)[words.at]))])
        first = np.cumsum(size) - size
        left = np.maximum(1 - (taken[:-1] - taken[first[r.text]]), 0.02) if len(new) else new
        # a word that was there: yes, and drawn from the words so far; a new one: no, and spelled from what is left
        cost = np.log10(np.where(had, yes * r.times / np.maximum(r.place, 1), (1 - yes) / left)) + np.where(had, 0.0, new)
        total = np.bincount(r.text, cost, len(size))
        # the end is a new word too; its place is behind the last one
        after = Repeats(np.arange(len(size)), size, np.zeros(len(size), np.int64), np.bincount(r.text, had, len(size)), self._end_cells(r, size))
        yes = np.where(size > 0, self.yes(*self.inputs(after)), 0.0)
        return total + np.log10(1 - yes) + end - np.log10(np.maximum(1 - (taken[first + size] - taken[first]), 0.02))

    @staticmethod
    def _end_cells(r: Repeats, size: np.ndarray) -> np.ndarray:
        step = np.minimum(np.floor(np.log2(size + 1)).astype(np.int64), PLACE_STEPS - 1)
        had, last = np.concatenate([r.had, [False]]).astype(np.int64), np.zeros(len(size), np.int64)
        behind = np.cumsum(size)
        for k in (1, 2, 3):
            last |= np.where(size >= k, had[np.maximum(behind - k, 0)], 0) << (k - 1)
        return np.stack([step * 8 + last, np.full(len(size), PLACE_STEPS * 8)])


def spans(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(bucket[a]), a, z


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split()


def pooled(table: pa.Table) -> pa.Table:
    """A bucket's distinct words, sorted as they are coded, and their training counts."""
    total: dict[bytes, int] = {}
    for words, times in zip(table["words"].to_pylist(), table["times"].to_pylist()):
        for w, n in zip(unpack_words(words), unpack_any(times).tolist()):
            total[w] = total.get(w, 0) + n
    order = sorted(total, key=coded)
    counts = np.fromiter(map(total.__getitem__, order), np.uint64, len(total))
    row = [[table["bucket"][0].as_py()], [pack_words(order)], [pack_any(counts)], [int(counts.sum())], [int((counts > 0).sum())]]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.table([pa.array(x, t) for x, t in zip(row, kinds)], ["bucket", "words", "times", "tokens", "known"])


Part = tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]


def parts(words: list[bytes], times: np.ndarray, size: int) -> Iterator[Part]:
    """A bucket's sorted words, so many at a time, with their counts and those of their beginnings."""
    seen, went = beginnings([coded(w) for w in words], times)
    ends = np.concatenate([[0], 8 * np.cumsum([len(w) + 1 for w in words])]).astype(np.int64)
    for k in range(0, len(words), size):
        a, z = ends[k], ends[min(k + size, len(words))]
        yield words[k : k + size], times[k : k + size], seen[a:z], went[a:z]


def _training(batches: Iterator[pa.RecordBatch], size: int = STEP_WORDS) -> Iterator[Part]:
    """Training words, so many at a time."""
    for batch in batches:
        for words, times in zip(batch["words"].to_pylist(), batch["times"].to_pylist()):
            times = unpack_any(times).astype(np.float64)
            seen = times > 0
            yield from parts([w for w, x in zip(unpack_words(words), seen.tolist()) if x], times[seen], size)


def counted(vocabulary: DataFrame, ends: int) -> np.ndarray:
    """The tables of all training words and ends: zeros and ones of each slot. Bounded by ``TABLE``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, TABLE))
        for words, times, _, _ in _training(batches, 20_000):
            b = bits_of(words)
            w = times[b.word]
            for slots in b.slots:
                for bit in (0, 1):
                    on = b.bit == bit
                    np.add(total[bit], np.bincount(slots[on], w[on], TABLE), out=total[bit]) if on.sum() > TABLE // 8 else np.add.at(total[bit], slots[on], w[on])
        for k in range(0, TABLE, RANGE):
            if total[:, k : k + RANGE].any():
                body = zstandard.ZstdCompressor(level=1).compress(total[:, k : k + RANGE].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([body], pa.binary())], ["start", "body"])

    def add_up(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.float32).astype(np.float64) for x in table["body"].to_pylist())
        body = zstandard.ZstdCompressor(level=1).compress(total.astype(np.float32).tobytes())
        return pa.table({"start": pa.array([table["start"][0].as_py()], pa.int64()), "body": pa.array([body], pa.binary())})

    counts = np.zeros((2, TABLE), np.float32)
    summed = vocabulary.mapInArrow(count, "start bigint, body binary").groupBy("start").applyInArrow(add_up, "start bigint, body binary")
    for row in summed.collect():  # at most TABLE / RANGE rows
        body = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.body), np.float32).reshape(2, -1)
        counts[:, row.start : row.start + body.shape[1]] = body
    if ends:
        b = bits_of([END])
        for slots in b.slots:
            np.add.at(counts[0], slots[b.bit == 0], ends)
            np.add.at(counts[1], slots[b.bit == 1], ends)
    return counts


def fitted(vocabulary: DataFrame, ends: int) -> tuple[Model, Broadcast]:
    """The model, and its tables as they were sent to the executors, once. Tables first, then one online pass of the mixer in each partition over its training words; weights are averaged and the refining counts
    added over the partitions."""
    spark = vocabulary.sparkSession
    shape = (GATES, INPUTS)
    start = Model(counted(vocabulary, ends), np.full(shape, 0.3), np.full((GATES, BINS), 0.5))
    sent = spark.sparkContext.broadcast(start.counts)  # of a fixed size, by ORDERS

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(sent.value, np.full(shape, 0.3), np.empty(0))
        seen = np.zeros((2, GATES * BINS))
        used, steps = np.zeros(GATES), np.full(shape, 1e-4)
        for words, times, began, went in _training(batches):
            b = bits_of(words, began, went)
            odds, gate = own.learn(b, times, steps)
            at, w = gate * BINS + bin_of(own.mix(odds, gate)), times[b.word]
            seen[0] += np.bincount(at, w, GATES * BINS)
            seen[1] += np.bincount(at, w * b.bit, GATES * BINS)
            used += np.bincount(gate, w, GATES)
        rows = [("w", k, float(x * used[k // shape[1]]), float(used[k // shape[1]])) for k, x in enumerate(own.weights.ravel())]
        rows += [("r", k, float(seen[1][k]), float(seen[0][k])) for k in np.flatnonzero(seen[0]).tolist()]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["kind", "cell", "x", "n"]), preserve_index=False)

    learned = vocabulary.mapInArrow(learn, "kind string, cell bigint, x double, n double")
    model = start
    for r in learned.groupBy("kind", "cell").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect():
        if r.kind == "w" and r.n > 0:
            model.weights.ravel()[r.cell] = r.x / r.n
        elif r.kind == "r":
            centre = 1 / (1 + np.exp(-((r.cell % BINS) * 24 / (BINS - 1) - 12)))
            model.refined.ravel()[r.cell] = (r.x + 20 * centre) / (r.n + 20)
    return model, sent


ASKED = "bucket bigint, block bigint, words binary, times binary, cell bigint, no double, yes double, body binary"
SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"


def asked(stored: DataFrame, bits: int) -> DataFrame:
    """What blocks ask buckets about (their distinct words with their training counts), and per task what it learned about "had already" (cell: of the counts,
    or behind them of the weights, as sums over the words that a gate had), and per block the occurrences of its words (body), stored."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had = Had(np.zeros((2, HAD_CELLS)), np.full((PLACE_STEPS, HAD_INPUTS), 0.3))
        steps, used = np.full(had.weights.shape, 1e-4), np.zeros(PLACE_STEPS)
        names = ["bucket", "block", "words", "times", "cell", "no", "yes", "body"]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.binary())

        def rows(*columns: list) -> pa.RecordBatch:
            n = max(len(c) for c in columns)
            return pa.RecordBatch.from_arrays([pa.array(c or [None] * n, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for block, content in zip(batch["block"].to_pylist(), batch["content"].to_pylist()):
                own = unpack(content)
                words, learned = block_words(own, bits), np.array(own["learned"].to_pylist(), bool)
                times = np.bincount(words.at[np.repeat(learned, words.size)], minlength=len(words.distinct)).astype(np.uint64)
                had.learn(repeats(words), learned, steps, used)
                cuts = list(spans(words.bucket))
                if cuts:
                    yield rows([k for k, _, _ in cuts], [block] * len(cuts), [pack_words(words.distinct[a:z]) for _, a, z in cuts], [pack_any(times[a:z]) for _, a, z in cuts], [], [], [], [])
                yield rows([], [block], [], [], [], [], [], [words.packed(own)])
        some = np.flatnonzero(had.counts.any(0)).tolist()
        cells = some + [HAD_CELLS + k for k in range(had.weights.size)]
        gate = np.repeat(used, HAD_INPUTS)
        yield rows([], [], [], [], cells, [*had.counts[0][some].tolist(), *gate.tolist()], [*had.counts[1][some].tolist(), *(had.weights.ravel() * gate).tolist()], [])

    return stage(stored.mapInArrow(ask, ASKED), "mixer-words")


def had_model(told: DataFrame) -> Had:
    """Counts added, weights averaged over the tasks; as many rows as cells."""
    model = Had(np.zeros((2, HAD_CELLS)), np.full((PLACE_STEPS, HAD_INPUTS), 0.3))
    for r in told.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).collect():
        if r.cell < HAD_CELLS:
            model.counts[:, r.cell] = r.no, r.yes
        elif r.no > 0:
            model.weights.ravel()[r.cell - HAD_CELLS] = r.yes / r.no
    return model


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row."""
    number = F.coalesce(fold(F.col("doc_id")), F.lit(-1))
    docs = docs.select("doc_id", "text", (number == HELD_FOLD).alias("held_out"), (~number.isin(HELD_FOLD, -1)).alias("learned"))
    stored = blocks(docs, name="mixer-blocks", most_bytes=block_bytes)
    bits = bucket_count(stored).bit_length() - 1
    told = asked(stored, bits)
    own_words = told.filter("bucket IS NOT NULL").select("bucket", "block", "words", "times")
    vocabulary = stage(own_words.groupBy("bucket").applyInArrow(pooled, "bucket bigint, words binary, times binary, tokens bigint, known bigint"), "mixer-vocabulary")
    totals = vocabulary.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("known"), F.lit(0)).alias("known")).first()
    ends = docs.filter("learned").count()
    tokens, distinct = totals.tokens + ends, totals.known + (ends > 0)
    model, sent = fitted(vocabulary, ends)
    had = had_model(told)
    weights, refined = model.weights, model.refined
    end = float(model.log10([END])[0])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        words, times = unpack_words(right["words"][0].as_py()), unpack_any(right["times"][0].as_py())
        model = Model(sent.value, weights, refined)
        value = [model.log10(w, seen, went) for w, _, seen, went in parts(words, times.astype(np.float64), 4_096)]
        place = {w: k for k, w in enumerate(words)}
        value = np.concatenate(value) if value else np.empty(0)
        out = []
        for block, own in zip(left["block"].to_pylist(), left["words"].to_pylist()):
            at = np.array([place[w] for w in unpack_words(own)], np.int64)
            out.append((block, left["bucket"][0].as_py(), pack_any(times[at]), value[at].astype("<f4").tobytes()))
        return pa.Table.from_pandas(pd.DataFrame(out, columns=["block", "bucket", "times", "value"]), preserve_index=False)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        own, n_bytes, words = Words.unpacked(left["body"][0].as_py())
        heard = sorted(zip(right["bucket"].to_pylist(), right["times"].to_pylist(), right["value"].to_pylist()))
        times = np.concatenate([unpack_any(x[1]) for x in heard]) if heard else np.empty(0, np.uint64)
        value = np.concatenate([np.frombuffer(x[2], "<f4") for x in heard]).astype(np.float64) if heard else np.empty(0)
        base = np.log10((times.astype(np.float64) + 0.5) / (tokens + 0.5 * (distinct + 1)))
        last = np.log10((ends + 0.5) / (tokens + 0.5 * (distinct + 1)))
        size, r = words.size, repeats(words)
        known = np.bincount(r.text, times[words.at] > 0, len(size)) + (ends > 0)
        total = had.log10(r, words, value, end)
        whole = lambda x: pa.array(x.astype(np.int64))
        columns = [own["doc_id"], own["held_out"], whole(size + 1), whole(known), whole(np.full(len(size), tokens)),
                   pa.array(np.bincount(r.text, base[words.at], len(size)) + last), pa.array(total), pa.array(-total / np.log10(2) / np.maximum(n_bytes, 1))]
        return pa.table(columns, [x.split()[0] for x in SCORED.split(", ")])

    answers = own_words.select("bucket", "block", "words").groupBy("bucket").cogroup(vocabulary.select("bucket", "words", "times").groupBy("bucket"))
    answers = answers.applyInArrow(answer, "block bigint, bucket bigint, times binary, value binary")
    bodies = told.filter("body IS NOT NULL").select("block", "body")
    return bodies.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCORED)
