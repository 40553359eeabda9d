"""Roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is a sequence of rows (conv_id, turn, raw) whose lines may open with a speaker marker or not. Each line is emitted by a state:
a role, and whether the line opens a turn or goes on with one. Start, transition and emission probabilities are counted over all labelled
training rows; emissions are independent features of a line: its marker, length, ending, and the kind of its first character. The most
likely states are found by Viterbi; a line whose state opens a turn starts a canonical turn.

Rows are sorted globally and cut into blocks of ``BLOCK_ROWS``, so one conversation that holds a third of all rows spans many blocks.
A block gives, for a conversation that crosses its border, the best score from each state before it to each state after it; these small
matrices are chained per conversation, which fixes the states at the borders, and then every block is decoded on its own. The result is
that of one Viterbi pass (ties: the least state). Transitions across a block border are not counted in learning.

Null or empty raw texts are one empty line. Rows without conv_id form one transcript; rows that repeat (conv_id, turn) follow each other, ordered by
a hash of their text. Roles outside ``ROLES`` and null roles are not learned from. Without training rows all states are equally likely."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.sources.tables import stage

ROLES = ("system", "user", "assistant", "tool")
#: Speaker markers, lower case. What stands before a colon at the start of a line and is none of these is "other".
MARKERS = (
    "system", "instructions", "user", "human", "me", "q", "question", "customer", "assistant", "ai", "bot", "a", "answer", "agent",
    "tool", "function", "result",
)
STATES = 2 * len(ROLES)
FEATURES = (len(MARKERS) + 2, 6, 5, 5)
BLOCK_ROWS = 2_000
FOLDS, HELD_FOLD = 5, 0
SMOOTH = 0.5


def marked(line: str) -> tuple[int, str]:
    """Number of the marker (0: none, 1: other) and the line without a known one. Stars and brackets around it are dropped."""
    head, colon, rest = line.partition(":")
    name = head.strip(" *[]<>#").lower()
    if not colon or len(head) > 20 or " " in name or not name:
        return 0, line
    return (MARKERS.index(name) + 2, rest.lstrip(" *]>")) if name in MARKERS else (1, line)


def features(line: str) -> tuple[int, int, int, int]:
    marker, _ = marked(line)
    size = int(np.searchsorted((1, 20, 60, 150, 400), len(line), "right"))
    end = "?.!:".find(line.rstrip()[-1:]) + 1 if line.strip() else 0
    first = line.lstrip()[:1]
    kind = 0 if not first else 1 if first.isupper() else 2 if first.islower() else 3 if first.isdigit() else 4
    return marker, size, end, kind


def lines(raw: str | None) -> list[str]:
    return (raw or "").split("\n")


class Model:
    """Logarithms: start (states), move (states x states), emit (a table states x values per feature)."""

    def __init__(self, counts: dict[tuple[str, int, int], float]):
        table = lambda kind, n, m: np.array([[counts.get((kind, a, b), 0.0) for b in range(m)] for a in range(n)]) + SMOOTH
        share = lambda x: np.log(x / x.sum(-1, keepdims=True))
        self.start = share(table("start", 1, STATES))[0]
        self.move = share(table("move", STATES, STATES))
        self.emit = [share(table(f"emit{k}", STATES, n)) for k, n in enumerate(FEATURES)]

    def scores(self, seen: list[tuple[int, ...]]) -> np.ndarray:
        x = np.array(seen).reshape(-1, len(FEATURES))
        return sum(t[:, x[:, k]] for k, t in enumerate(self.emit)).T

    def through(self, e: np.ndarray, first: bool) -> np.ndarray:
        """Best score from each state before these lines to each at their end; ``first``: they open the transcript, one row."""
        m = (self.start + e[0])[None] if first else self.move + e[0]
        for row in e[1:]:
            m = (m[:, :, None] + self.move[None]).max(1) + row
        return m

    def path(self, e: np.ndarray, before: int | None, after: int | None) -> np.ndarray:
        """Most likely states of the lines, given those before (none: start) and at the end (none: the best)."""
        d = (self.start if before is None else self.move[before]) + e[0]
        back = np.zeros((len(e), STATES), np.int64)
        for k in range(1, len(e)):
            m = d[:, None] + self.move
            back[k] = m.argmax(0)
            d = m.max(0) + e[k]
        states = np.empty(len(e), np.int64)
        states[-1] = int(d.argmax()) if after is None else after
        for k in range(len(e) - 1, 0, -1):
            states[k - 1] = back[k, states[k]]
        return states


def ordered(rows: DataFrame) -> DataFrame:
    """The rows in global order, stored, with ``block`` and ``place`` in it."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, start = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            at = np.arange(n, n + b.num_rows)
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(start + at // BLOCK_ROWS), pa.array(at % BLOCK_ROWS)], [*b.schema.names, "block", "place"])

    by = ["conv_id", "turn", F.xxhash64("raw")]
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by, "raw")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", block bigint, place bigint"
    return stage(sorted_.mapInArrow(numbered, schema), "transcripts")


def runs(block: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of each conversation of a block, in order."""
    block = block.sort_values("place", kind="stable")
    same = block.conv_id.eq(block.conv_id.shift()) | (block.conv_id.isna() & block.conv_id.shift().isna())
    same.iloc[0] = False
    for _, run in block.groupby((~same).cumsum(), sort=False):
        yield run


def learned(stored: DataFrame) -> Model:
    """Counts of the rows with ``learn`` and a known role; at most a few hundred sums reach the driver."""

    def counted(block: pd.DataFrame) -> pd.DataFrame:
        total: dict[tuple[str, int, int], int] = {}

        def add(*key) -> None:
            total[key] = total.get(key, 0) + 1

        for run in runs(block):
            before = None
            for turn, role, raw, learn in zip(run.place, run.role, run.raw, run.learn):
                if not learn or role not in ROLES:
                    before = None
                    continue
                for k, line in enumerate(lines(raw)):
                    state = 2 * ROLES.index(role) + (k > 0)
                    if before is not None:
                        add("move", before, state)
                    elif turn == run.place.iloc[0] and k == 0:
                        add("start", 0, state)
                    for f, value in enumerate(features(line)):
                        add(f"emit{f}", state, value)
                    before = state
        return pd.DataFrame([(*k, n) for k, n in total.items()], columns=["kind", "a", "b", "n"])

    parts = stored.select("block", "place", "conv_id", "role", "raw", "learn").groupBy("block").applyInPandas(counted, "kind string, a int, b int, n bigint")
    sums = parts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Model({(r.kind, r.a, r.b): float(r.n) for r in sums})


def _borders(stored: DataFrame, model: Model) -> DataFrame:
    """(block, end, conv_id, before, after, last): the states that Viterbi takes around the part of a conversation at an end of a block
    (0: its first conversation, 1: its last) where the conversation goes on in another block."""

    def summed(block: pd.DataFrame) -> pd.DataFrame:
        all_ = list(runs(block))
        out = []
        for end, run in ((0, all_[0]), (1, all_[-1])):
            if end and len(all_) == 1:
                continue
            e = model.scores([features(x) for raw in run.raw for x in lines(raw)])
            first, inner = model.through(e, True), model.through(e, False)
            out.append((run.block.iloc[0], end, run.conv_id.iloc[0], first.tobytes(), inner.tobytes()))
        return pd.DataFrame(out, columns=["block", "end", "conv_id", "first", "inner"])

    def chained(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block", kind="stable")
        if len(rows) < 2:
            return pd.DataFrame(columns=["block", "end", "before", "after", "last"])
        best, back = None, []
        for first, inner in zip(rows["first"], rows.inner):
            if best is None:
                best = np.frombuffer(first).reshape(1, STATES)[0]
                back.append(None)
            else:
                m = best[:, None] + np.frombuffer(inner).reshape(STATES, STATES)
                back.append(m.argmax(0))
                best = m.max(0)
        after = [int(best.argmax())]
        for choice in back[:0:-1]:
            after.append(int(choice[after[-1]]))
        after.reverse()
        n = len(rows)
        return pd.DataFrame({
            "block": rows.block, "end": rows.end, "before": [-1, *after[:-1]], "after": after, "last": [k == n - 1 for k in range(n)],
        })

    conv = dict(stored.dtypes)["conv_id"]
    parts = stored.select("block", "place", "conv_id", "raw").groupBy("block").applyInPandas(
        summed, f"block bigint, end int, conv_id {conv}, first binary, inner binary"
    )
    return parts.groupBy("conv_id").applyInPandas(chained, "block bigint, end int, before int, after int, last boolean")


def recover(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """Of every row of (conv_id, turn, role, raw, learn): conv_id, turn, role, ``found_role`` (of its first line), ``n_lines``,
    ``n_agree`` (lines found in the given role), ``rendered``: its part of the canonical transcript. The parts of a conversation, joined
    in order, are its canonical rendering."""
    stored = ordered(rows.select("conv_id", "turn", "role", "raw", "learn"))
    model = model or learned(stored)
    borders = stage(_borders(stored, model), "transcript-borders")

    def decoded(block: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        names = ["conv_id", "turn", "role", "found_role", "n_lines", "n_agree", "rendered"]
        if not len(block):
            return pd.DataFrame(columns=names)
        known = {r.end: r for r in around.itertuples()}
        all_, out = list(runs(block)), []
        for k, run in enumerate(all_):
            edge = known.get(0 if k == 0 else 1 if k == len(all_) - 1 else -1)
            text = [lines(raw) for raw in run.raw]
            before = None if edge is None or edge.before < 0 else int(edge.before)
            states = model.path(model.scores([features(x) for t in text for x in t]), before, None if edge is None else int(edge.after))
            opened, at = before is not None, 0
            for n, (conv, turn, role, own) in enumerate(zip(run.conv_id, run.turn, run.role, text)):
                part, agree, found = [], 0, None
                for line in own:
                    name = ROLES[states[at] // 2]
                    body = marked(line)[1].replace("<|im_", "<\\|im_")
                    if states[at] % 2 == 0 or not opened:
                        part.append(("<|im_end|>\n" if opened else "") + f"<|im_start|>{name}\n{body}")
                    else:
                        part.append("\n" + body)
                    opened, at, agree, found = True, at + 1, agree + (name == role), found or name
                if n == len(run) - 1 and (edge is None or edge.last):
                    part.append("<|im_end|>\n")
                out.append((conv, turn, role, found, len(own), agree, "".join(part)))
        return pd.DataFrame(out, columns=names)

    kinds = dict(stored.dtypes)
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, found_role string, n_lines bigint, n_agree bigint, rendered string"
    return stored.groupBy("block").cogroup(borders.groupBy("block")).applyInPandas(decoded, schema)


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of stored conversations: one of four styles of markers per conversation, and one turn in seven without a marker; ``learn``
    tells the training conversations, those whose crc32 of the id modulo 5 is not 0."""
    styles = [
        {"user": "User: ", "assistant": "Assistant: ", "system": "System: ", "tool": "Tool: "},
        {"user": "Human: ", "assistant": "AI: ", "system": "Instructions: ", "tool": "Function: "},
        {"user": "Q: ", "assistant": "A: ", "system": "System: ", "tool": "Result: "},
        {"user": "**Customer**: ", "assistant": "**Agent**: ", "system": "**System**: ", "tool": "**Tool**: "},
    ]
    style, marker = F.pmod(F.xxhash64("conv_id"), F.lit(len(styles))), F.lit("")
    for k, words in enumerate(styles):
        for role, word in words.items():
            marker = F.when((style == k) & (F.col("role") == role), F.lit(word)).otherwise(marker)
    plain = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(7)) == 0
    held = F.crc32(F.col("conv_id").cast("string").cast("binary")) % FOLDS == HELD_FOLD
    raw = F.concat(F.when(plain, F.lit("")).otherwise(marker), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", "turn", "role", raw.alias("raw"), (~F.coalesce(held, F.lit(False))).alias("learn"))
