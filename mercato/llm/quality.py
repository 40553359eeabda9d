"""Quality rules with risk-controlled cutoffs.

Every text gets a few statistics; a rule rejects a text whose statistic lies beyond a cutoff. Cutoffs are chosen
per stratum (language) on labelled good texts. A quarter of them, by a hash of the id, only shapes a path of ``STEPS`` joint
policies, from one that hardly rejects to the strictest cutoffs each of which rejects at most ``RISK`` of that quarter: all rules
are tightened together. The others are for tests along the path: a policy stands as long as an exact binomial test shows that its
rules together reject at most ``RISK`` of the good texts. Tests in a fixed order that end at the first failure
need no correction; the error level is divided over the strata and their pool (Bonferroni). So with probability 1 - ``ERROR`` no
stratum with cutoffs of its own loses more than ``RISK`` of its good texts; with four strata that takes 90 texts to test, about 120 in all.
A stratum with fewer takes the cutoffs that stand for all strata pooled, if it has ``LEAST_OWN`` good texts or more, of
which these reject at most ``RISK``; the bound then holds for the pool. A stratum without that has no cutoffs, only the base rule.

Null and empty texts have no words: all counts 0, rejected by the base rule. A null language is a stratum of its
own. Rows that repeat an id are judged each; label rows of one id count once (good if all say so). Null labels
are left out. Empty tables give empty results."""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from mercato.llm.tables import lookup, widened
from mercato.llm.text import payloads, rows
from mercato.sources.tables import stage

#: Share of good texts of a stratum that all rules together may reject, and the probability that this fails.
RISK, ERROR = 0.05, 0.05
#: Policies on a path, one of so many good texts shapes it, and own good texts that a stratum needs to take the pooled cutoffs.
STEPS, SHAPING, LEAST_OWN = 64, 4, 20
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Candidate cutoffs of each rule, lenient to strict. A text is rejected above the cutoff.
CANDIDATES = {
    "symbols_per_word": np.geomspace(4, 0.01, 64),
    "marks_per_word": np.geomspace(4, 0.01, 64),
    "upper_share": np.linspace(0.98, 0.05, 64),
    "dup_line_share": np.linspace(0.98, 0.02, 64),
    "repeat_share": np.linspace(0.98, 0.02, 64),
    "word_length": np.geomspace(64, 5, 64),
    "short_words": np.geomspace(1, 0.2, 64),
}
RULES = tuple(CANDIDATES)

_SPACE = bytes([32, *range(9, 14)])
_INNER = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    m = len(number)
    if m < 2_000_000:
        _, place, times = np.unique((ids[:-2] * m + ids[1:-1]) * m + ids[2:], return_inverse=True, return_counts=True)
    else:  # the product would not fit 64 bits: number the pairs first
        _, pairs = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)
        _, place, times = np.unique(pairs[:-1] * m + ids[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, marks, capitals, letters."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    without = lambda drop: len(text) - len(text.translate(None, drop))
    return (
        len(words), len(text.translate(None, _SPACE + _INNER)), without(_SYMBOLS), len(lines) - len(set(lines)),
        _repeated(words), len(lines), without(_MARKS), without(_UPPER), without(_LETTERS),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper", "n_letters")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the counts added. No shuffle."""
    docs = docs.drop(*COUNTS)
    schema = widened(docs, **dict.fromkeys(COUNTS, LongType()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            got = np.array([measure(x) for x in payloads(b[text])], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, got.T.copy())], [*b.schema.names, *COUNTS])

    return docs.mapInArrow(counted, schema)


def statistics() -> list:
    """The statistic of each rule, from the counts."""
    over = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1))
    return [
        over("n_symbols", "n_words").alias("symbols_per_word"), over("n_marks", "n_words").alias("marks_per_word"),
        over("n_upper", "n_letters").alias("upper_share"), over("n_dup_lines", "n_lines").alias("dup_line_share"),
        over("n_repeat_words", "n_words").alias("repeat_share"), over("word_chars", "n_words").alias("word_length"),
        over("n_words", "word_chars").alias("short_words"),
    ]


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of n trials, exact at any size: the incomplete beta function by its continued fraction."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0

    def beta_part(a: float, b: float, x: float) -> float:
        front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
        c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
        h = d
        for m in range(1, 100_000):
            for t in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1 / (1 + t * d or 1e-300)
                c = 1 + t / c or 1e-300
                h *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return front * h

    a, b, x = n - k, k + 1, 1 - p
    return beta_part(a, b, x) if x < (a + 1) / (a + b + 2) else 1 - beta_part(b, a, p)


def choose(rejected: np.ndarray, n: int, risk: float, error: float) -> int:
    """Number of candidates that stand: ``rejected[i]`` of the n good texts are beyond candidate i."""
    for i, k in enumerate(rejected):
        if binomial_cdf(int(k), n, risk) > error:
            return i
    return len(rejected)


def _below(rule: str):
    return lambda cutoff: F.col(rule) > cutoff


def certified(good: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, pooled, one cutoff per rule, null: none) of each stratum and of all pooled, from (doc_id, stratum, statistics) of
    labelled good texts."""
    # a text is beyond the last candidates of a rule: the number of the first of them, from 0
    first = [(F.lit(len(CANDIDATES[r])) - F.size(F.filter(F.lit(list(map(float, CANDIDATES[r]))), _below(r)))).alias(r) for r in RULES]
    shapes = (F.pmod(F.xxhash64("doc_id"), F.lit(SHAPING)) == 0).alias("shapes")
    both = F.explode(F.array(F.struct("stratum", F.lit(False).alias("pooled")), F.struct(F.lit("").alias("stratum"), F.lit(True).alias("pooled"))))
    texts = good.select(both.alias("of"), shapes, *first).select("of.*", "shapes", *RULES)
    own = ["stratum", "pooled"]

    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("first")) for r in RULES]))
    beyond = texts.filter("shapes").select(*own, each.alias("x")).groupBy(*own, "x.rule", "x.first").agg(F.count(F.lit(1)).alias("texts"))

    def shaped(group: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {c: [group[c].iloc[0]] for c in own}
        for rule in RULES:
            x, size = group[group.rule == rule], len(CANDIDATES[rule])
            rejected = np.bincount(x["first"], x.texts, size + 1).cumsum()
            out[f"end_{rule}"] = [int((rejected[:size] <= risk * x.texts.sum()).sum())]
        return pd.DataFrame(out)

    # groups of at most rules x candidates counts; a stratum none of whose texts shapes goes through all candidates
    ends = beyond.groupBy(*own).applyInPandas(shaped, "stratum string, pooled boolean, " + ", ".join(f"end_{r} int" for r in RULES))
    every = texts.select(*own).distinct()
    ends = every.join(ends, own, "left").fillna({f"end_{r}": len(CANDIDATES[r]) for r in RULES})
    ends = lookup(ends.crossJoin(every.agg(F.count(F.lit(1)).alias("tests"))))

    # step s takes the first ceil(s * end / STEPS) candidates of each rule
    step = lambda r: F.when(F.col(f"end_{r}") > 0, F.floor(F.col(r) * STEPS / F.col(f"end_{r}")) + 1).otherwise(STEPS + 1)
    tested = texts.filter("not shapes").join(ends, own)
    steps = tested.groupBy(*own, F.least(*map(step, RULES), F.lit(STEPS + 1)).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("texts")).join(ends, own)

    def chosen(group: pd.DataFrame) -> pd.DataFrame:
        one = group.iloc[0]
        out: dict[str, list] = {c: [one[c]] for c in own}
        rejected = np.bincount(group.step - 1, group.texts, STEPS + 1).cumsum()
        stand = choose(rejected[:STEPS], int(group.texts.sum()), risk, error / int(one.tests))
        for rule in RULES:
            used = -(-stand * int(one[f"end_{rule}"]) // STEPS)
            out[rule] = [float(CANDIDATES[rule][used - 1]) if used else None]
        return pd.DataFrame(out)

    return steps.groupBy(*own).applyInPandas(chosen, "stratum string, pooled boolean, " + ", ".join(f"{r} double" for r in RULES))


def cutoffs(good: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, pooled, one cutoff per rule, null: none) of the strata that have cutoffs, their own or the pooled ones."""
    good = stage(good.select("doc_id", "stratum", *RULES), "quality-good")
    found = stage(certified(good, risk, error).filter(F.coalesce(*RULES).isNotNull()), "quality-cutoffs")
    own, pool = found.filter("not pooled"), found.filter("pooled").drop("stratum")
    limits = F.broadcast(pool.select("pooled", *[F.col(r).alias(f"most_{r}") for r in RULES]))  # one row
    rejected = F.greatest(*[F.coalesce((F.col(r) > F.col(f"most_{r}")).cast("int"), F.lit(0)) for r in RULES])
    few = good.join(own.select("stratum"), "stratum", "left_anti").crossJoin(limits).groupBy("stratum")
    few = few.agg(F.count(F.lit(1)).alias("texts"), F.sum(rejected).alias("lost")).filter((F.col("texts") >= LEAST_OWN) & (F.col("lost") <= risk * F.col("texts")))
    return own.unionByName(few.select("stratum").crossJoin(F.broadcast(pool)).select("stratum", "pooled", *RULES))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """doc_id, lang, the counts, ``base_failed``, ``kept`` and ``reasons`` (rules a text fails) of every row."""
    counts = stage(measured(docs.select("doc_id", "lang", "text")).drop("text"), "quality")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = counts.select("*", base.alias("base_failed"), F.coalesce("lang", F.lit("")).alias("stratum"), *statistics())
    good = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    limits = lookup(cutoffs(judged.filter("not base_failed").join(good, "doc_id", "left_semi"), risk, error))
    limits = limits.select("stratum", *[F.col(r).alias(f"most_{r}") for r in RULES])
    failed = F.array_compact(F.array(*[F.when(F.col(r) > F.col(f"most_{r}"), F.lit(r)) for r in RULES]))
    out = judged.join(limits, "stratum", "left").withColumn("reasons", failed)
    return out.select(
        "doc_id", "lang", *COUNTS, "base_failed", (~F.col("base_failed") & (F.size("reasons") == 0)).alias("kept"), "reasons"
    )
