"""Required strings of regexes, the index over them, and names that are nearly in a text."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.operators import factors, fuzzy, matching, quality
from mercato.sources.tables import stage


@pytest.mark.parametrize(
    "pattern, want",
    [
        (r"\bred\s*widget\b", {"widget"}), ("(?:abc|defg)+x?", {"abc", "defg"}), ("a?bcd*", {"bc"}), ("foo(bar)?baz", {"foo"}), ("(?i)x", None),
        ("x{2,3}yy", {"yy"}), (r"[abc]def\.com", {"def.com"}), ("a|", None), (r"ab\1", None), ("ab+c", {"ab"}), ("(?!no)yes", {"yes"}), ("[^]x]a", None),
        ("a{0}bc", {"bc"}), ("", None), ("(ab", None), ("a)b", None), (r"\Qa\E", None), ("(?<n>hello) x", {"hello"}), (r"x\d\d\dyz", {"yz"}),
    ],
)
def test_required(pattern, want):
    got = factors.required(pattern)
    assert got == (frozenset(want) if want is not None else None)


_ATOMS = st.sampled_from(["a", "b", "cab", "[ab]", ".", r"\d", "(?:ab|c)", "(a|b)", r"\b", "(?:abc)", " "])
_PATTERNS = st.lists(st.tuples(_ATOMS, st.sampled_from(["", "", "?", "*", "+", "{2}", "{0,2}", "+?"])), min_size=1, max_size=5).map(
    lambda parts: "".join(a + ("" if a == r"\b" else q) for a, q in parts)
)


@given(st.lists(_PATTERNS, min_size=1, max_size=3).map("|".join), st.lists(st.sampled_from("abc 1"), max_size=14).map("".join))
@settings(max_examples=600, deadline=None)
def test_every_match_has_a_required_string(pattern, text):
    need = factors.required(pattern)
    if need and re.search(pattern, text):
        assert any(s in text for s in need)


def test_regexes_are_tried_where_their_trigram_is(spark, rows):
    rng = random.Random(3)
    words = ["red", "widget", "blue", "bolt", "64gb", "gizmo", "x1"]
    texts = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 9)))) for k in range(200)]
    patterns = [rf"\b{a}\s+{b[:3]}[a-z]*\b" for a in words for b in words] + [r"\bred\b.*\b(?:64|32)gb\b", r"\bx\d\b", "(?:gizmo|bolt) red"] * 8
    df = spark.createDataFrame(texts, "id long, text string")
    entries = spark.createDataFrame([(f"e{k}", p) for k, p in enumerate(patterns)], "name string, pattern string")
    want = sorted((k, f"e{n}", m.start() + 1) for k, t in texts for n, p in enumerate(patterns) if (m := re.search(p, t)))
    assert rows(matching.first_matches(df, entries, ["name"]), "id", "name") == sorted(want)
    grams = factors.chosen_grams(patterns)
    lookup = spark.createDataFrame([(f"e{k}", p, g) for k, (p, own) in enumerate(zip(patterns, grams)) for g in own or ()], "name string, pattern string, gram string")
    tried = matching.factor_candidates(df, lookup, []).select("id", "name").distinct().count()
    assert tried < len(texts) * len(patterns) / 2
    nothing = spark.createDataFrame([(1, "zzzz qqqq"), (2, "")], "id long, text string")
    assert matching.factor_candidates(nothing, lookup, []).count() == 0


def test_texts_are_never_broadcast_and_tried_only_where_all_strings_are(spark):
    pattern = r"\bsma[a-z]*\s+gizmo\b(?:.*)\b12\s*(?:gb|go?)\b"
    assert factors.certain(pattern) == ["gizmo", "sma", "12"] and factors.certain("(?i)x") == [""] * factors.NEEDED
    texts = stage(spark.createDataFrame([(1, "small gizmo 12 gb"), (2, "small gizmo 13 gb"), (3, "old gizmo 12 gb")], "id long, text string"), "texts")
    entries = [("e", pattern, "giz", *factors.certain(pattern))]
    lookup = spark.createDataFrame(entries, "name string, pattern string, gram string, " + ", ".join(f"{c} string" for c in matching._NEEDS))
    tried = matching.factor_candidates(texts, lookup, [])
    assert [r.id for r in tried.collect()] == [1]
    plan = tried._jdf.queryExecution().sparkPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_similar_names_equal_all_pairs(spark):
    rng = random.Random(6)
    names = ["ab", "galaxy note", "galaxy note 10", "moto g power", "one plus nord ce lite", "pixel", "thirty letters of a long name x"]

    def typo(s, n):
        for _ in range(n):
            k = rng.randrange(len(s) + 1)
            s = s[:k] + rng.choice(["", "x", " ", "ab"]) + s[k + rng.randrange(2) :]
        return " ".join(s.split())

    texts = [(k, " ".join([rng.choice(["new", "a", "case"]), typo(rng.choice(names), rng.randrange(4)), "for sale"])) for k in range(150)] + [(999, "")]
    want = {}
    for k, t in texts:
        w = t.split(" ")
        runs = {" ".join(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        for n in names:
            good = [1 - distance(r, n) / max(len(r), len(n)) for r in runs if 10 * distance(r, n) <= max(len(r), len(n))]
            if good:
                want[k, n] = max(good)
    df = spark.createDataFrame(texts, "id long, text string")
    got = fuzzy.similar(df, spark.createDataFrame([(n,) for n in names], "name string"))
    assert {(r.id, r.name): r.similarity for r in got.collect()} == pytest.approx(want)
    best = {r.id: r.name for r in fuzzy.best(df, spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert best == {k: min((n for i, n in want if i == k), key=lambda n: (-want[k, n], n)) for k in {i for i, _ in want}}


def test_quantiles(spark):
    df = spark.range(20_000).select((F.col("id") % 1000).alias("a"), F.lit(None).cast("int").alias("b"))
    got = {(r.column_name, r.quantile): r for r in quality.quantiles(df, ["a", "b"]).collect()}
    assert all(abs(got["a", q].value - 1000 * q) <= 1000 * quality.RANK_ERROR + 1 for q in (0.25, 0.5, 0.75))
    assert abs(got["a", 0.5].n_distinct - 1000) < 50 and got["b", 0.5].value is None
