"""Byte-level BPE: encoding and decoding by Spark higher-order functions.

Texts are cut by the tokenizer's pattern; a task encodes each distinct piece that it meets once. A piece starts
as the array of its bytes (their ids); a fold joins, step by step, the adjacent pair with the least rank, the leftmost of
equals (all of them where they are many, as in long runs without a blank), until no pair has a rank. The rank map: from the ids of two neighbours to the rank, which is the id,
of what they make, kept as one array by row displacement (Spark's own maps are searched entry by entry). It is broadcast once, and stands beside the pieces of a block as an array column: no plan
holds it. Decoding looks the ids of a text up in the tokens' bytes (Arrow's ``take``) and joins them.

Texts are looked up by what stands between blanks, where the pattern allows that (``SPACED``); what is new there is cut by the pattern.

No shuffle: texts go through a task in blocks of some ``BLOCK_BYTES`` (or one longer text). A block is a row of the pieces that are
new to the task and the places of all its pieces; after the fold the same task puts the ids of its texts together. Where there are many texts, the pieces of
some ``SAMPLE_TEXTS`` of them are folded first and sent to all tasks, which fold only what is new to them: this saves work and is no part of what is right. Null texts count as empty, with no tokens; repeated rows are encoded each; other columns are left alone."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.blocks import cut
from mercato.llm.text import release

BLOCK_BYTES, BLOCK_TEXTS = 2_000_000, 2_048
#: A pattern of which a piece begins at each space before anything but white space, whatever stands around, and that leaves any of its pieces
#: whole where it stands alone.
SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A task forgets the pieces, and words of several, that it has met when it knows more than these.
MOST_PIECES = 1_000_000
#: Texts whose pieces are folded beforehand (where there are four times as many), and how many of these pieces at most; longer ones are left to the tasks.
SAMPLE_TEXTS, SAMPLE_PIECES, SAMPLE_BYTES = 10_000, 400_000, 64
SPAN = 4_096
#: Parts up to which a step may look at all of them; pairs of one rank that are joined in one step beyond.
SHORT, MANY = 256, 64
#: Above every rank; an entry of another row, or none, gives at least this.
NONE, EMPTY = 2**17, 2**60


def read_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: lines of base64 bytes and rank."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def displaced(rows: dict[int, dict[int, int]]) -> tuple[list[int], np.ndarray]:
    """A sparse table in one array by row displacement: row ``a`` is laid over the array from place ``shift[a]`` on, where its
    entries fall on free places. Entry: a * NONE + value, or EMPTY. Long rows are laid first."""
    shift = [0] * (max(rows, default=0) + 1)
    size = 4 * sum(map(len, rows.values())) + max((max(r) for r in rows.values()), default=0) + SPAN
    first, taken, table = 0, np.zeros(size, bool), np.full(size, EMPTY, np.int64)
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        cols = np.fromiter(row, np.int64, len(row))
        cols.sort()
        at = first - int(cols[0])
        while True:
            fits = at + np.flatnonzero(~taken[at + cols[0] : at + cols[0] + SPAN])
            for c in cols[1:]:
                fits = fits[~taken[fits + c]]
            if len(fits):
                break
            at += SPAN
        shift[a] = int(fits[0])
        taken[fits[0] + cols] = True
        table[fits[0] + cols] = a * NONE + np.array([row[c] for c in cols.tolist()], np.int64)
        first += int(np.argmin(taken[first:]))
    return shift, table[: int(np.flatnonzero(taken).max(initial=0)) + 1].copy()


def let(value: Column, body) -> Column:
    """An expression of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass(frozen=True)
class Ranks:
    """The rank map as one array and the place of each row in it; tokens of which all pairs cannot be joined at once."""

    table: Column
    shift: Column
    early: Column


#: The columns of ``Ranks`` beside the pieces of a block.
RANKS = "table array<bigint>, shift array<bigint>, early array<bigint>"


class Cutter:
    """What tasks need of a tokenizer to cut texts."""

    def __init__(self, tokenizer: Tokenizer):
        self.pattern, self.byte_ids, self.whole = tokenizer.pattern, tokenizer.byte_ids, tokenizer.whole


class Tokenizer:
    """The arrays and the fold for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.byte_ids = np.array([ranks[bytes([c])] for c in range(256)], np.int64)
        pairs: dict[int, dict[int, int]] = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
                if a is not None and b is not None:
                    pairs.setdefault(a, {})[b] = rank
        #: Tokens that merges alone do not reach; a piece equal to one is that token.
        self.whole = {x: r for x, r in ranks.items() if _merged(x, ranks) != [r]}
        shift, table = displaced(pairs)
        names = [b""] * (max(ranks.values(), default=0) + 1)
        for piece, rank in ranks.items():
            names[rank] = piece
        #: The bytes of the tokens, behind one another, and how many each has.
        self.names, self.name_sizes = b"".join(names), np.array([*map(len, names)], np.int32)
        #: Tokens that make a pair of lower rank than their own: all pairs of their rank cannot be joined at once.
        early = {x for a, row in pairs.items() for b, rank in row.items() for x in (a, b) if rank < x}
        shift += [len(table)] * (len(names) - len(shift))
        #: By the names of ``RANKS``.
        self.arrays = (table, np.array(shift, np.int64), np.array(sorted(early), np.int64))

    @staticmethod
    def rank(t: Ranks, a: Column, b: Column) -> Column:
        """Rank, which is the id, of the token that two neighbours make; NONE or more if they make none, NULL if there is no second."""
        return F.get(t.table, F.get(t.shift, a) + b).bitwiseXOR(F.shiftleft(a, 17))

    def encode(self, pieces: Column) -> Column:
        """array<array<bigint>> of pieces, each given as the ids (bigint) of its bytes, in rows that hold the columns of ``RANKS``; these are bound once a row."""

        def each(t: Ranks) -> Column:
            return F.transform(pieces, lambda ids: F.when(F.size(ids) <= SHORT, self.encode_short(t, ids)).otherwise(self.encode_long(t, ids)))

        return let(F.col("table"), lambda table: let(F.col("shift"), lambda shift: let(F.col("early"), lambda early: each(Ranks(table, shift, early)))))

    def encode_short(self, t: Ranks, ids: Column) -> Column:
        """A fold over the parts of a piece, whose ranks are looked up anew in each step: least work per step for a few parts."""

        def joined(parts: Column, place: Column, made: Column) -> Column:
            """``made`` at ``place`` (from 1) for the two parts from there."""
            put = F.transform(parts, lambda x, k: F.when(k == place, F.lit(None)).when(k == place - 1, made).otherwise(x))
            return F.filter(put, lambda x: x.isNotNull())

        def step(s: Column, _: Column) -> Column:
            p = s["parts"]
            ranks = F.transform(p, lambda a, k: self.rank(t, a, F.get(p, k + 1)))
            end = F.struct(p.alias("parts"), F.lit(True).alias("done"))

            def join(r: Column, least: Column) -> Column:
                parts = let(F.array_position(r, least), lambda place: joined(p, place, least))
                return F.when(least < NONE, F.struct(parts.alias("parts"), F.lit(False).alias("done"))).otherwise(end)

            return F.when(s["done"], s).otherwise(let(ranks, lambda r: let(F.array_min(r), lambda least: join(r, least))))

        start = F.struct(ids.alias("parts"), (F.size(ids) < 2).alias("done"))
        return F.aggregate(ids, start, step, lambda s: s["parts"])

    def encode_long(self, t: Ranks, ids: Column) -> Column:
        """The state of the fold is the parts and the rank of each with its next;
        a step cuts both arrays at the pair of least rank and looks two new ranks up, so it moves memory but computes nothing
        for the other parts. Where the least rank is that of ``MANY`` pairs or more, a step joins all of them, from the left."""

        def state(parts: Column, ranks: Column) -> Column:
            return F.struct(parts.alias("parts"), ranks.alias("ranks"))

        def all_ranks(parts: Column) -> Column:
            return F.transform(parts, lambda a, k: F.coalesce(self.rank(t, a, F.get(parts, k + 1)), F.lit(EMPTY)))

        def one(p: Column, q: Column, made: Column) -> Column:
            def cut(at: Column) -> Column:  # at: place of the pair, from 1
                before = F.when(at > 1, F.array(F.coalesce(self.rank(t, F.get(p, at - 2), made), F.lit(EMPTY)))).otherwise(F.array().cast("array<bigint>"))
                parts = F.concat(F.slice(p, F.lit(1), at - 1), F.array(made), F.slice(p, at + 2, F.size(p)))
                after = F.array(F.coalesce(self.rank(t, made, F.get(p, at + 1)), F.lit(EMPTY)))
                return state(parts, F.concat(F.slice(q, F.lit(1), F.greatest(at - 2, F.lit(0))), before, after, F.slice(q, at + 2, F.size(p))))

            return let(F.array_position(q, made).cast("int"), cut)

        def every(p: Column, q: Column, made: Column) -> Column:
            # of pairs that overlap ("11") the left one; a part is replaced, dropped behind a replaced one, or kept
            marks = F.array_join(F.transform(q, lambda r: F.when(r == made, "1").otherwise("0")), "")
            chosen = F.split(F.regexp_replace(marks, "11", "10"), "")

            def put(m: Column) -> Column:
                new = F.transform(p, lambda x, k: F.when(F.get(m, k) == "1", made).when((k > 0) & (F.get(m, k - 1) == "1"), F.lit(None)).otherwise(x))
                return let(F.filter(new, lambda x: x.isNotNull()), lambda parts: state(parts, all_ranks(parts)))

            return let(chosen, put)

        def step(s: Column, _: Column) -> Column:
            p, q = s["parts"], s["ranks"]

            def join(made: Column) -> Column:
                many = (F.size(q) > MANY) & (F.size(q) - F.size(F.array_remove(q, made)) >= MANY) & ~F.array_contains(t.early, made)
                end = state(p, F.array().cast("array<bigint>"))
                return F.when(made < NONE, F.when(many, every(p, q, made)).otherwise(one(p, q, made))).otherwise(end)

            return F.when(F.size(q) > 0, let(F.array_min(q), join)).otherwise(s)

        return F.aggregate(ids, state(ids, all_ranks(ids)), step, lambda s: s["parts"])


def _merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        joins = [ranks.get(a + b, 2**31) for a, b in zip(parts, parts[1:])]
        least = min(joins)
        if least == 2**31:
            break
        k = joins.index(least)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return [ranks[x] for x in parts]


def starts_of(words: list[bytes], tokenizer: Cutter) -> pa.ListArray:
    """What the fold starts with: the ids of the bytes of each piece, or the token that merges do not reach."""
    values, starts = tokenizer.byte_ids[np.frombuffer(b"".join(words), np.uint8)], np.cumsum([0, *map(len, words)])
    if tokenizer.whole:
        whole = tokenizer.whole
        return pa.array([[whole[w]] if w in whole else values[a:z].tolist() for w, a, z in zip(words, starts, starts[1:])], pa.list_(pa.int64()))
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int64()))


class Known(NamedTuple):
    """Pieces that are folded already: how many bytes and tokens each has, all bytes and all ids behind one another. Broadcast as a plain
    tuple: executors have no copy of this class."""

    sizes: np.ndarray
    lengths: np.ndarray
    text: bytes
    values: np.ndarray


def binaries(data: bytes | pa.Buffer, ends: np.ndarray) -> pa.BinaryArray:
    """Byte strings that lie behind one another; ``ends`` begins with 0."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def places_of(sizes: np.ndarray, text: bytes) -> dict[str, int]:
    ends = np.cumsum(sizes).tolist()
    return {text[a:z].decode(): k for k, (a, z) in enumerate(zip([0, *ends], ends))}


class Blank(Exception):
    """A word that white space begins: the space before it begins no piece by itself."""


class Words(dict):
    """What follows a space -> its number in ``Pieces``."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, word: str) -> int:
        if self.pieces.white.match(word):
            raise Blank
        number = self[word] = self.pieces.segment(" " + word)
        return number


class Pieces:
    """Numbers of pieces, in the order in which they are met; ``new``: those met since that list was emptied. Where the pattern is ``SPACED``, a text is
    looked up by its words; a word that is several pieces has the complement of its place in ``sizes`` for a number."""

    def __init__(self, pattern: str, known: Iterable[str] = ()):
        self.pattern, self.white, self.space = regex.compile(pattern), regex.compile(r"\s|$"), regex.compile(r" (?=\S)")
        self.spaced = pattern == SPACED
        self.words, self.others, self.n = Words(self), {}, 0
        self.sizes, self.parts = array("i"), array("i")
        self.new: list[str] = []
        for piece in known:
            self.number(piece)
        self.new.clear()

    def __len__(self) -> int:
        return len(self.words) + len(self.others)

    def number(self, piece: str) -> int:
        follows = self.spaced and piece.startswith(" ") and not self.white.match(piece, 1)
        held, key = (self.words, piece[1:]) if follows else (self.others, piece)
        number = held.get(key)
        if number is None:
            number = held[key] = self.n
            self.n += 1
            self.new.append(piece)
        return number

    def segment(self, text: str) -> int:
        found = [self.number(x) for x in self.pattern.findall(text)]
        if len(found) == 1:
            return found[0]
        self.sizes.append(len(found))
        self.parts.extend(found)
        return ~(len(self.sizes) - 1)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the pieces of texts (null: none), behind one another, and where each text ends."""
        found, ends = array("i"), []
        for text in texts:
            text, before = text or "", len(found)
            if not self.spaced:
                found.extend([self.number(x) for x in self.pattern.findall(text)])
            else:
                head, *rest = text.split(" ")
                try:
                    found.extend(map(self.words.__getitem__, rest))
                except Blank:
                    del found[before:]
                    head, *rest = self.space.split(text)
                    found.extend(map(self.words.__getitem__, rest))
                if head not in self.others:
                    self.others[head] = self.segment(head)
                found.insert(before, self.others[head])
            ends.append(len(found))
        return self.flat(np.array(found, np.int32), np.array([0, *ends]))

    def flat(self, found: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        several = found < 0
        sizes = np.array(self.sizes, np.int64)
        which, size = ~found[several], np.ones(len(found), np.int64)
        size[several] = n = sizes[which]
        places, total = np.repeat(found, size), np.concatenate([[0], np.cumsum(size)])
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.cumsum(sizes) - sizes
        places[np.repeat(total[:-1][several], n) + within] = np.array(self.parts, np.int32)[np.repeat(first[which], n) + within]
        return places, total[ends[1:]]


def beside(arrays: tuple[np.ndarray, ...]) -> list[pa.ListArray]:
    """The columns of ``RANKS`` for one row."""
    return [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in arrays]


def known_pieces(docs: DataFrame, tokenizer: Tokenizer, texts: int = SAMPLE_TEXTS) -> Known:
    """The folded pieces of about so many texts, of each bucket of pieces no more than its share of ``SAMPLE_PIECES``; none where texts are few."""
    none = Known(np.empty(0, np.int64), np.empty(0, np.int64), b"", np.empty(0, "<i4"))
    share = docs.count() // texts
    if share < 4:
        return none
    cutter, buckets = Cutter(tokenizer), 16
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer.arrays)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Pieces(cutter.pattern)
        for batch in batches:
            for b in cut(batch, "text", BLOCK_BYTES, BLOCK_TEXTS):
                if len(found) < MOST_PIECES:
                    found.of(b["text"].to_pylist())
        words = [w for x in found.new if len(w := x.encode()) <= SAMPLE_BYTES]
        for k in range(0, len(words), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[k : k + 20_000], pa.binary())], ["piece"])
        del found, words
        release()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, ranks = SAMPLE_PIECES // buckets, beside(sent.value)
        for batch in batches:
            words = batch["piece"].to_pylist()[:left]
            left -= len(words)
            for k in range(0, len(words), 5_000):
                some = words[k : k + 5_000]
                inner = starts_of(some, cutter)
                pieces = pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)
                sizes = np.array([*map(len, some)], "<i4").tobytes()
                row = [pa.array([sizes], pa.binary()), pa.array([b"".join(some)], pa.binary()), pieces, *ranks]
                yield pa.RecordBatch.from_arrays(row, ["sizes", "text", "pieces", "table", "shift", "early"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [b["tokens"][k].values for k in range(b.num_rows)]
            lengths = [np.diff(x.offsets.to_numpy()).astype("<i4").tobytes() for x in lists]
            ids = [x.flatten().to_numpy().astype("<i4").tobytes() for x in lists]
            yield pa.RecordBatch.from_arrays([b["sizes"], b["text"], pa.array(lengths, pa.binary()), pa.array(ids, pa.binary())], ["sizes", "text", "lengths", "ids"])

    some = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    # no more rows of a piece than tasks; those of most tasks first
    pieces = some.mapInArrow(met, "piece binary").groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    pieces = pieces.repartition(buckets, "piece").sortWithinPartitions(F.desc("n")).select("piece")
    starts = pieces.mapInArrow(listed, f"sizes binary, text binary, pieces array<array<bigint>>, {RANKS}")
    folded = starts.select("sizes", "text", tokenizer.encode(F.col("pieces")).alias("tokens"))
    rows = folded.mapInArrow(packed, "sizes binary, text binary, lengths binary, ids binary").collect()  # some MB
    sent.unpersist()
    numbers = lambda name: np.frombuffer(b"".join(r[name] for r in rows), "<i4")
    return Known(numbers("sizes"), numbers("lengths"), b"".join(bytes(r["text"]) for r in rows), numbers("ids"))


def encoded(docs: DataFrame, tokenizer: Tokenizer, sample: int = SAMPLE_TEXTS) -> DataFrame:
    """(doc_id, ids binary of little-endian 32-bit integers, decoded binary), one row per row."""
    cutter = Cutter(tokenizer)
    known = known_pieces(docs, tokenizer, sample)
    sent = docs.sparkSession.sparkContext.broadcast((*known, tokenizer.arrays, tokenizer.names, tokenizer.name_sizes))  # of a bounded size

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, _, known_text, _, arrays, *_ = sent.value
        met, ranks = Pieces(cutter.pattern, places_of(sizes, known_text)), beside(arrays)
        for batch in batches:
            for b in cut(batch, "text", BLOCK_BYTES, BLOCK_TEXTS):
                if len(met) > MOST_PIECES:
                    met = Pieces(cutter.pattern, places_of(sizes, known_text))
                before = met.n
                places, ends = met.of(b["text"].to_pylist())
                inner = starts_of([x.encode() for x in met.new], cutter)
                met.new.clear()
                row = [[b["doc_id"].to_pylist()], [ends], [places.tobytes()], [before]]
                kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64())
                new = pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)
                names = ["doc_ids", "ends", "places", "before", "pieces", "table", "shift", "early"]
                yield pa.RecordBatch.from_arrays([*map(pa.array, row, kinds), new, *ranks], names)
        del met
        release()

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, lengths, _, ids, _, bytes_of, name_sizes = sent.value
        values, length = ids, lengths.astype(np.int64)
        names = binaries(bytes_of, np.concatenate([[0], np.cumsum(name_sizes)]))
        for batch in batches:
            for k in range(batch.num_rows):
                if batch["before"][k].as_py() == len(lengths):
                    values, length = ids, lengths.astype(np.int64)
                if batch["before"][k].as_py() != len(length):
                    raise RuntimeError("blocks of a task came out of order")
                tokens = batch["tokens"][k].values
                values = np.concatenate([values, tokens.flatten().to_numpy().astype("<i4")])
                length = np.concatenate([length, np.diff(tokens.offsets.to_numpy())])
                first = np.cumsum(length) - length
                places = np.frombuffer(batch["places"][k].as_py(), np.int32)
                n = length[places]
                total = np.concatenate([[0], np.cumsum(n)])
                at = np.repeat(first[places] - total[:-1], n) + np.arange(total[-1])
                ends = np.array([0, *batch["ends"][k].as_py()], np.int64)
                got, cuts = values[at], total[ends]
                said = names.take(pa.array(got, pa.int32()))
                # the looked-up bytes lie behind one another, so that a text is a cut of them
                place = np.concatenate([[0], np.cumsum(name_sizes[got], dtype=np.int64)])[cuts]
                decoded = binaries(said.buffers()[2] or b"", place)
                yield pa.RecordBatch.from_arrays([pa.array(batch["doc_ids"][k].as_py(), pa.int64()), binaries(got.tobytes(), 4 * cuts), decoded], ["doc_id", "ids", "decoded"])
        del values, length
        release()

    columns = f"doc_ids array<bigint>, ends array<bigint>, places binary, before bigint, pieces array<array<bigint>>, {RANKS}"
    coded = docs.select("doc_id", "text").mapInArrow(pieces, columns)
    coded = coded.select("doc_ids", "ends", "places", "before", tokenizer.encode(F.col("pieces")).alias("tokens"))
    return coded.mapInArrow(put_together, "doc_id bigint, ids binary, decoded binary")


def digests(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded(docs, tokenizer).select(
        "doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
