"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A reads a space and the text, tokenizer B the text, to which it adds the space itself; both cut the same bytes. The
tokens of A and B are sorted together by their first byte (lexsort), the running maximum of their ends (maximum.accumulate)
closes a group wherever the next token starts at it or later, and inside a group the tokens that overlap are linked. Whole batches of texts lie
one behind the other on one axis of bytes, so a few array operations align them all; a text's end closes a group by itself.

How often an id pair is linked is counted over the corpus. A block of texts is written once, with its distinct pairs, their
counts and its links as places in that list; pairs are summed, each with whether it is the most frequent of its B id, and
joined back, one row per block and distinct pair. So the pairs of a text that a third of all rows repeat cost one row
per block, and no table grows with documents times vocabulary.

Null and empty texts, and texts whose tokens do not give back the space and the text byte by byte (B may normalise), have
no tokens: zeros and an empty string. Rows are taken one by one, so repeated ids and ids that are null get rows of their own; other columns are left
alone. Memory of a task is that of a part (``PART_BYTES``), of the links of a block (``BLOCK_BYTES``) or of the longest text."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.blocks import cut
from mercato.sources.tables import stage

BLOCK_BYTES, BLOCK_ROWS = 3_000_000, 8_192
#: Bytes of text that are aligned at once.
PART_BYTES = 250_000
#: A pair is a * SIDE + b; no vocabulary here has as many ids.
SIDE = 1 << 20

SCORED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


@dataclass(frozen=True)
class Vocabularies:
    """The two tokenizer files, sent with the tasks: some MB, whatever the data."""

    a_json: str
    b_model: bytes

    @classmethod
    def read(cls, a_path: str, b_path: str) -> Vocabularies:
        return cls(Path(a_path).read_text("utf-8"), Path(b_path).read_bytes())


#: How byte-level vocabularies cut texts into pieces, where their file asks for it (``use_regex``).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones stand for themselves, the others, in order, for
    the characters from U+0100 on."""
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    other = [c for c in range(256) if c not in set(plain)]
    return {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(other)}


def bytes_of(a_json: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary; special tokens have none."""
    letters, file = byte_level(), json.loads(a_json)
    special = {x["id"] for x in file["added_tokens"]}
    own = {i: bytes(map(letters.__getitem__, x)) for x, i in file["model"]["vocab"].items() if i not in special}
    return [own.get(i, b"") for i in range(max(own) + 1)]


def ranked(a_json: str) -> dict[bytes, int] | None:
    """The vocabulary as ranks, if the file says no more than that: ids in the order of the merges, the usual pieces, nothing
    normalised. None for other files."""
    file = json.loads(a_json)
    model, before = file["model"], file["pre_tokenizer"]
    merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    made = [model["vocab"].get("".join(x)) for x in merges]
    plain = file["normalizer"] is None and before == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if not plain or made != list(range(256, 256 + len(made))) or model.get("ignore_merges") or model.get("dropout"):
        return None
    return {x: i for i, x in enumerate(bytes_of(a_json)) if x}


class Cutter:
    """Both tokenizers in a task, with the bytes of every id. A file that is no more than ranks is read by tiktoken, which gives the same ids
    in a quarter of the time; any other by the library that the file is made for."""

    def __init__(self, vocabularies: Vocabularies):
        import sentencepiece

        self.a_bytes = bytes_of(vocabularies.a_json)
        self.a = self._ranks(vocabularies.a_json) or self._file(vocabularies.a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]

    @staticmethod
    def _ranks(a_json: str) -> Callable[[str], Sequence[int]] | None:
        import tiktoken

        ranks = ranked(a_json)
        return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary if ranks else None

    @staticmethod
    def _file(a_json: str) -> Callable[[str], Sequence[int]]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(a_json)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of each text; none where they do not give the text back."""
        a_ids: list[list[int]] = [[] for _ in texts]
        b_ids: list[list[int]] = [[] for _ in texts]
        for k, text in enumerate(texts):
            if text:
                x, y, want = self.a(" " + text), self.b.encode(text, num_threads=1), (" " + text).encode()
                if b"".join([self.a_bytes[i] for i in x]) == want and b"".join([self.b_bytes[i] for i in y]) == want:
                    a_ids[k], b_ids[k] = x, y
        return a_ids, b_ids


class Aligner:
    """Groups and links of batches of texts, given as ids of both sides."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.lengths = [np.array(list(map(len, x)), np.int64) for x in (a_bytes, b_bytes)]
        #: Text of an id (A's ids, then B's) and what stands behind it: three strings in a row for each.
        self.words = np.array([f"{i}{s}" for x in (a_bytes, b_bytes) for i in range(len(x)) for s in (",", "|", ";")], object)

    def __call__(self, a_ids: list[list[int]], b_ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Per text: number of groups, number of links, the groups as text; and the pair of each link, in order of texts."""
        sides = [np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (a_ids, b_ids)]
        length = [size[ids] for size, ids in zip(self.lengths, sides)]
        end = [np.cumsum(x) for x in length]
        start = [e - x for e, x in zip(end, length)]
        (na, nb), counts = map(len, sides), [np.array(list(map(len, ids)), np.int64) for ids in (a_ids, b_ids)]
        ends = [np.concatenate([[0], np.cumsum(n)]) for n in counts]

        kind = np.repeat(np.array([0, 1]), [na, nb])
        first, last = np.concatenate(start), np.concatenate(end)
        order = np.lexsort((kind, first))
        reach = np.maximum.accumulate(last[order]) if na + nb else last
        opens = np.ones(na + nb, bool)
        opens[1:] = first[order][1:] >= reach[:-1]
        group = np.empty(na + nb, np.int64)
        group[order] = np.cumsum(opens) - 1

        a_group = np.concatenate([group[:na], [group.max(initial=-1) + 1]])
        n_groups = a_group[ends[0][1:]] - a_group[ends[0][:-1]]

        # inside its group a token of A overlaps the tokens of B from the one that ends after its start to the one that starts before its end
        low = np.searchsorted(end[1], start[0], "right")
        n = np.searchsorted(start[1], end[0], "left") - low
        upto = np.cumsum(n)
        at_b = np.repeat(low - (upto - n), n) + np.arange(upto[-1] if na else 0)
        pairs = np.repeat(sides[0], n) * SIDE + sides[1][at_b]
        before = np.concatenate([[0], upto])
        n_links = before[ends[0][1:]] - before[ends[0][:-1]]

        shown = np.argsort(group * 2 + kind, kind="stable")
        ids = np.concatenate([sides[0], sides[1] + len(self.lengths[0])])[shown]
        after = np.full(na + nb, 2)
        same = group[shown][1:] == group[shown][:-1]
        after[:-1][same] = np.where(kind[shown][1:] == kind[shown][:-1], 0, 1)[same]
        words = self.words[ids * 3 + after].tolist()
        bounds = ends[0] + ends[1]
        texts = ["".join(words[x:y])[:-1] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return n_groups, n_links, texts, pairs


def _ready(vocabularies: Vocabularies) -> tuple[Cutter, Aligner]:
    cutter = Cutter(vocabularies)
    return cutter, Aligner(cutter.a_bytes, cutter.b_bytes)


def aligned(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """(doc_id, a_ids, b_ids, groups): the ids of both tokenizers and the groups as text, ``a1,a2|b1;a3|b2,b3``. No shuffle."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, aligner = _ready(vocabularies)
        for batch in batches:
            for b in cut(batch, "text", PART_BYTES, BLOCK_ROWS):
                a_ids, b_ids = cutter(b["text"].to_pylist())
                _, _, groups, _ = aligner(a_ids, b_ids)
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(a_ids, kind), pa.array(b_ids, kind), pa.array(groups, pa.string())], ["doc_id", "a_ids", "b_ids", "groups"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(mapped, "doc_id bigint, a_ids array<int>, b_ids array<int>, groups string")


def linked(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Blocks of texts, stored: (block, docs, pairs, counts, links). docs: what is known of each text before pairs are counted over
    the corpus; pairs, ascending, and counts: the block's distinct ones; links: the place of each link's pair in them."""

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, aligner = _ready(vocabularies)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for whole in cut(batch, "text", BLOCK_BYTES, BLOCK_ROWS):
                rows, found = [], []
                for b in cut(whole, "text", PART_BYTES, BLOCK_ROWS):
                    a_ids, b_ids = cutter(b["text"].to_pylist())
                    n_groups, n_links, groups, pairs = aligner(a_ids, b_ids)
                    found.append(pairs)
                    digest = [sha256(x.encode()).hexdigest() if x else "" for x in groups]
                    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
                    columns = (b["doc_id"].to_pylist(), map(len, a_ids), map(len, b_ids), n_groups.tolist(), n_links.tolist(), digest)
                    rows += [dict(zip(names, x)) for x in zip(*columns)]
                pairs, place, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
                links = zstandard.ZstdCompressor(level=1).compress(place.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([rows], pa.list_(row)), pa.array([pairs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([links], pa.binary())],
                    ["block", "docs", "pairs", "counts", "links"],
                )
                block += 1

    numbers = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
    row = pa.struct([*((x, pa.int64()) for x in numbers), ("groups_sha256", pa.string())])
    schema = f"block bigint, docs array<struct<{', '.join(f'{x}: bigint' for x in numbers)}, groups_sha256: string>>, pairs array<bigint>, counts array<bigint>, links binary"
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return stage(rows.mapInArrow(blocked, schema), "alignment")


def asked(blocks: DataFrame) -> DataFrame:
    """(block, pair, count): the distinct pairs of each block."""
    both = blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    return both.select("block", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("count"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, total, best): links of a pair over the corpus, and whether no pair of its B id has more. A B id has at most as many pairs as A
    has ids, so the window's groups are bounded by the vocabulary."""
    totals = asked(blocks).groupBy("pair").agg(F.sum("count").alias("total"))
    own = Window.partitionBy(F.col("pair") % SIDE)
    return totals.withColumn("best", F.col("total") == F.max("total").over(own))


def digests(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (an empty string without tokens) of every row."""
    blocks = linked(docs, vocabularies)
    answers = asked(blocks).select("block", "pair").join(pair_counts(blocks), "pair")
    # one list per block, of its distinct pairs: at most as many as a block's bytes
    answers = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pair", "total", "best"))).alias("x"))
    answers = answers.select("block", F.col("x.total").alias("total"), F.col("x.best").alias("best"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = pa.RecordBatch.from_struct_array(batch["docs"][k].values)
                links = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch["links"][k].as_py()), "<u4")
                ends = np.cumsum(rows["n_links"].to_numpy())
                out = []
                for name in ("best", "total"):
                    values = batch[name][k].values
                    values = np.empty(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False).astype(np.int64)
                    sums = np.concatenate([[0], np.cumsum(values[links])])
                    out.append(pa.array(np.diff(sums[np.concatenate([[0], ends]).astype(np.int64)]), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(rows[x] for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *out, rows["groups_sha256"]],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return blocks.select("block", "docs", "links").join(answers, "block", "left").drop("block").mapInArrow(summed, SCORED)
