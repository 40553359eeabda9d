"""Spelling variants against all pairs of a small vocabulary; what the filters let pass."""

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import spelling

SCHEMA = "doc_id long, text string"


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    words = counted(rows)
    form, out = {}, {}
    for w, n in words.items():
        near = sorted((-words[x], x) for x in words if one_edit(w, x))
        form[w] = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[w] = (n, len(near))
    rows = []
    for w, (n, n_near) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, words[form[w]] if form[w] else None))
    return sorted(rows)


def corpus():
    rng = np.random.default_rng(3)
    stems = ["garden", "gardens", "gardem", "hardened", "straße", "strasse", "naïveté", "naiveté", "÷×÷×÷×", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abcdefghij", "bcdefghij", "short"]
    stems += ["".join(rng.choice(list("abé"), 6)) for _ in range(60)]
    stems += ["z" * 60, "z" * 59, "z" * 30 + "y" + "z" * 29, "q" * 4000, "q" * 3999 + "x"]
    weight = np.array([1 / (k % 17 + 1) ** 2 for k in range(len(stems))])
    rows = [(k, " ".join(rng.choice(stems, 60, p=weight / weight.sum())) + ", Garden-GARDEN ÄRMEL1") for k in range(300)]
    chain = [("anchor", 300), ("anchot", 50), ("anchott", 8), ("ancho", 9)]
    rows += [(1000 + k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    rows += [(2000, " ".join(["q" * 4000] * 3 + ["q" * 3999 + "x"] * 30)), (2001, None), (2002, ""), (2003, "1 2 ;  "), (None, "anchor anchor"), (1, "garden"), (1, "garden")]
    return rows


def test_equal_to_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS_A_TASK", 20)
    monkeypatch.setattr(spelling, "CELLS", 50)
    monkeypatch.setattr(spelling, "MOST_WORDS", 30)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("word", F.lit("mine")).withColumn("n", F.lit("mine")).repartition(5)
    got = sorted((tuple(r) for r in spelling.variants(docs).collect()), key=lambda r: r[0])
    want = plain(rows)
    assert got == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of two


def test_full_filters_let_nothing_go_missing(spark, monkeypatch):
    """Filters of a few blocks pass nearly everything; the exact join gives the same rows."""
    monkeypatch.setattr(spelling, "LEAST_BLOCKS", 1)
    monkeypatch.setattr(spelling, "BITS_PER_WORD", 1)
    rows = [x for x in corpus() if len(x[1] or "") < 3000]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in spelling.variants(docs).collect()), key=lambda r: r[0]) == plain(rows)


def test_size_of_filters_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_BLOCKS", spelling.LEAST_BLOCKS * (spelling.LONG + 2))
    vocab = spark.range(40_000).select(F.format_string("word%08x", "id").alias("word"), F.lit(5).cast("long").alias("n"))
    assert spelling.filters(vocab).blocks.size <= spelling.MOST_BLOCKS


@pytest.mark.parametrize("word, h, want", [("abcdefg", 199 * 4, "abcdfg" if 796 % 7 == 4 else None), ("a", 0, "")])
def test_edited(word, h, want):
    k = h % len(word)
    assert spelling.edited(word, h) == (want if want is not None else word[:k] + word[k + 1 :])


def test_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a b c")], SCHEMA)).count() == 0
