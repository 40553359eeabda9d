r"""Spelling variants: words one edit from a much more frequent word, by Bloom-guided neighbourhoods.

The vocabulary is counted in Spark (words of a task are summed before the shuffle). Its words set bits in blocked Bloom filters, one
filter per word length: a word's four bits lie in one 64-bit block. The filters are broadcast; their size follows the
vocabulary up to ``MOST_BLOCKS`` blocks (32 MB), never beyond, and a larger vocabulary only lets more false positives
through. Each word generates its neighbourhood as hashes: every replacement of one code point by one of the alphabet, and every
deletion (insertions are deletions seen from the other word). A hash is a polynomial of the code points, so an edit changes one
term of it and no string is made. Only what a filter lets pass becomes a string and is shuffled to an exact join with the
vocabulary, which removes the false positives. A word has at most (alphabet + 2) * length neighbours, so no group grows with the data.

Runs are maximal matches of ``[A-Za-zÀ-ÿ]+`` with A-Z lower-cased. Null and empty texts have none; a null id is
written as an empty string; repeated rows count each time; other columns are not read. Ties of the form: the smallest in
code-point order. Texts are read whole; a run of any length is one word."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import mixed, rows
from mercato.sources.tables import stage

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form must be this many times as frequent.
RATIO = 5
#: One distinct run of a document in so many loses a code point.
EDITED = 199
#: a-z and U+00C0 to U+00FF: all code points of a word.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Words that a task sums before it hands them on.
MOST_WORDS = 400_000
#: Words of so many code points or more share one filter.
LONG = 48
BITS_PER_WORD, LEAST_BLOCKS, MOST_BLOCKS = 16, 1 << 10, 1 << 22
#: Code points whose neighbourhoods are hashed at once.
CELLS = 20_000
WORDS_A_TASK = 4_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def edited(word: str, h: int) -> str:
    """The word without its code point h % length."""
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of at least so many code points and occurrences over all documents, stored."""
    find = f"[a-zÀ-ÿ]{{{least_length},}}"  # shorter runs give no word, with or without an edit

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(find)
        total: Counter[str] = Counter()

        def summed() -> pa.RecordBatch:
            kept = {w: n for w, n in total.items() if n}
            return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

        for b in rows(batches):
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                own = runs.findall((text or "").encode().translate(_LOWER).decode())
                start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                total.update(own)
                for w in set(own):
                    h = crc32(w.encode(), start)
                    if h % EDITED == 0:
                        n = own.count(w)
                        total[w] -= n
                        if len(w) > least_length:
                            total[edited(w, h)] += n
            if len(total) > MOST_WORDS:
                yield summed()
                total.clear()
        yield summed()

    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(counted, "word string, n bigint")
    return stage(found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count), "vocabulary")


def salt(length: int) -> np.uint64:
    """What a length adds to the hash of a word."""
    return np.uint64(length * 0xD6E8FEB86659FD93 % 2**64)


def powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), _BASE)]), dtype=np.uint64)


def by_length(words: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words of equal length with the matrix of their code points, in parts of about ``CELLS`` code points."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for n, group in groups.items():
        step = max(1, CELLS // n)
        for k in range(0, len(group), step):
            part = group[k : k + step]
            yield part, np.frombuffer("".join(part).encode("utf-32-le"), "<u4").reshape(len(part), n).astype(np.uint64)


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash and the bits that it has there."""
    h = mixed(hashes)
    bits = np.zeros_like(h)
    for k in range(4):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), bits


@dataclass
class Filters:
    """Blocked Bloom filters, one per length shard, behind each other in one array."""

    first: np.ndarray
    size: np.ndarray
    blocks: np.ndarray

    def passed(self, length: int, hashes: np.ndarray) -> np.ndarray:
        shard = min(length, LONG)
        if not self.size[shard]:
            return np.zeros(hashes.shape, bool)
        at, bits = places(hashes, int(self.size[shard]))
        return (self.blocks[at.astype(np.int64) + self.first[shard]] & bits) == bits


def shard_sizes(vocab: DataFrame) -> np.ndarray:
    """Blocks per shard (0 to LONG): 16 bits a word, less where the whole would exceed ``MOST_BLOCKS``."""
    counts = vocab.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("shard")).count().collect()  # at most LONG + 1 rows
    words = np.zeros(LONG + 1, np.int64)
    for shard, n in counts:
        words[shard] = n
    want = np.where(words > 0, np.maximum(words * BITS_PER_WORD // 64, LEAST_BLOCKS), 0)
    scale = min(1.0, (MOST_BLOCKS - LEAST_BLOCKS * (LONG + 1)) / max(1, want.sum()))
    return np.where(words > 0, np.maximum((want * scale).astype(np.int64), LEAST_BLOCKS), 0)


def filters(vocab: DataFrame) -> Filters:
    """Built where the words are; the bits of a block are joined by Spark, and at most ``MOST_BLOCKS`` blocks come back."""
    size = shard_sizes(vocab)
    first = np.cumsum(size) - size

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, codes in by_length(b["word"].to_pylist()):
                n = codes.shape[1]
                at, bits = places((codes * powers(n)).sum(1, dtype=np.uint64) + salt(n), int(size[min(n, LONG)]))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + first[min(n, LONG)]), pa.array(bits.view(np.int64))], ["block", "bits"])

    got = vocab.select("word").mapInArrow(placed, "block bigint, bits bigint").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    blocks = np.zeros(int(size.sum()), np.uint64)
    blocks[got["block"].to_numpy()] = got["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return Filters(first, size, blocks)


def neighbourhoods(words: list[str], sieve: Filters, alphabet: str = ALPHABET) -> Iterator[tuple[str, str]]:
    """(word, edit) of every edit that the filters let pass: replacements and deletions, each once."""
    letters = np.array(list(map(ord, alphabet)), np.uint64)
    for part, codes in by_length(words):
        n = codes.shape[1]
        power = powers(n)
        terms = codes * power
        whole = terms.sum(1, dtype=np.uint64) + salt(n)
        # without place k: what stands before it, and what stands behind it moved one place down
        moved = np.cumsum((codes[:, 1:] * power[:-1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        for k in range(n):
            tried = (whole - terms[:, k])[:, None] + (letters * power[k])[None, :]
            hit = sieve.passed(n, tried) & (letters[None, :] != codes[:, k : k + 1])
            for i, c in zip(*np.nonzero(hit)):
                yield part[i], part[i][:k] + alphabet[c] + part[i][k + 1 :]
            if n > 1:
                tried = before[:, k] + (moved[:, k] if k < n - 1 else np.uint64(0)) + salt(n - 1)
                hit = sieve.passed(n - 1, tried)
                if k:
                    hit &= codes[:, k] != codes[:, k - 1]  # the same string as without the place before
                for i in np.flatnonzero(hit):
                    yield part[i], part[i][:k] + part[i][k + 1 :]


def near(vocab: DataFrame, alphabet: str = ALPHABET) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of near words of the vocabulary, stored."""
    spark = vocab.sparkSession
    sieve = filters(vocab)
    sent = spark.sparkContext.broadcast((sieve.first, sieve.size, sieve.blocks))  # at most MOST_BLOCKS * 8 bytes

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = Filters(*sent.value)
        for b in batches:
            count = dict(zip(b["word"].to_pylist(), b["n"].to_pylist()))
            found = list(neighbourhoods(list(count), sieve, alphabet))
            columns = ([w for w, _ in found], [count[w] for w, _ in found], [x for _, x in found])
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.int64(), pa.string()))], ["word", "n", "other"])

    spread = vocab.repartition(max(1, vocab.count() // WORDS_A_TASK), "word")
    tried = spread.mapInArrow(probed, "word string, n bigint, other string")
    pairs = tried.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")
    # a deletion is met from the longer word only
    turned = F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    same = F.struct("word", "n", "other", "other_n")
    both = F.when(F.length("word") > F.length("other"), F.array(same, turned)).otherwise(F.array(same))
    return stage(pairs.select(F.explode(both).alias("x")).select("x.*"), "near-words")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form that is reached. Each round doubles the way, and a form is at least ``RATIO`` times
    as frequent as its word, so a few rounds end it."""
    way = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if way.join(step, "root", "left_semi").isEmpty():
            return way
        way = stage(way.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    vocab = vocabulary(docs, least_length, least_count)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    own = near(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows_ = vocab.join(own, "word", "left").withColumn("form_n", -F.col("best.less"))
    enough = F.col("form_n") >= ratio * F.col("n")
    found = stage(
        rows_.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
        ), "variants",
    )
    ends = roots(found.filter("form IS NOT NULL"))
    out = found.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
