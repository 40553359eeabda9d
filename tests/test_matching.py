import random
import re

import pytest
from pyspark.sql import functions as F

from mercato.operators import matching as m

BRANDS = [
    ("Apple", r"\b(apple|iphone)\b"),
    ("Samsung", r"\b(samsung|galaxy)\b"),
    ("Google", r"\b(google|pixel)\b"),
    ("OnePlus", r"\bone\s*plus\b"),
    ("One", r"\bone\b"),
]


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def brands(spark, extra=0):
    rows = BRANDS + [(f"Filler{i:03}", rf"\bfiller\s*{i}\b") for i in range(extra)]
    return frame(spark, rows, "brand string, pattern string")


@pytest.mark.parametrize("extra", [0, 100])
def test_detect_brand(spark, rows, extra):
    texts = [
        (1, "my iphone and galaxy"),
        (2, "galaxy or iphone"),
        (3, "nothing here"),
        (4, "apple samsung google"),
        (5, "apple samsung google one"),
        (6, "one plus 7"),
        (7, "oneplus 7"),
        (8, ""),
        (9, "iphone iphone iphone iphone galaxy"),
    ]
    got = rows(m.detect_brand(frame(spark, texts, "id bigint, text string"), brands(spark, extra)), "id", "brand")
    assert got == [(1, "Apple"), (2, "Samsung"), (4, "Apple"), (6, "One"), (6, "OnePlus"), (7, "OnePlus"), (9, "Apple")]


def test_multi_brand(spark, rows):
    texts = frame(spark, [(1, "apple samsung google one"), (2, "apple")], "id bigint, text string")
    for extra in (0, 100):
        assert rows(m.multi_brand(texts, brands(spark, extra))) == [(1, 4)]


def test_first_matches_positions(spark, rows):
    texts = frame(spark, [(1, "a galaxy s20 plus"), (2, "galaxy")], "id bigint, text string")
    for extra in (0, 100):
        got = rows(m.first_matches(texts, brands(spark, extra), ["brand"]), "id")
        assert got == [(1, "Samsung", 3), (2, "Samsung", 1)]


def models(spark, extra):
    rows = [
        ("Apple", "13", r"\b13\b", 2),
        ("Apple", "13 Pro", r"\b13\s*pro\b", 5),
        ("Apple", "13 Max", r"\b13\s*max\b", 5),
        ("Samsung", "A02", r"\ba\s*0?2\b", 3),
        ("Samsung", "13", r"\b13\b", 2),
        ("Samsung", "Dot", r"\bx.y\b", 3),
        ("OnePlus", "7", r"\bplus\s*7\b", 1),
        ("One", "7", r"\bplus\s*7\b", 1),
    ] + [("Apple", f"M{i}", rf"\bm\s*{i}\b", 2) for i in range(12)]
    rows += [("Other", f"F{i}", rf"\bf\s*{i}\b", 2) for i in range(extra)]
    return frame(spark, rows, "brand string, model string, pattern string, length int")


MODEL_TEXTS = [
    (1, "iphone 13 pro"),
    (2, "iphone 13"),
    (3, "iphone 13 max or 13pro"),  # equally long: the earlier
    (4, "iphone " + " ".join(f"m{i}" for i in range(10))),  # ten models: rejected
    (5, "galaxy a2"),
    (6, "galaxy a 02"),
    (7, "galaxy x1y"),  # a genuine regex
    (8, "one plus 7"),  # two brands, both with the model
    (9, "pixel 13"),  # brand without models
    (10, "13 pro"),  # no brand
    (11, "galaxy 13 pro iphone"),  # model of the first brand only
    (12, "iphone " + " ".join(f"m{i}" for i in range(9))),  # nine: kept
]


@pytest.mark.parametrize("extra", [0, 100])
def test_brand_model(spark, rows, extra):
    texts = frame(spark, MODEL_TEXTS, "id bigint, text string")
    got = rows(m.brand_model(texts, brands(spark), models(spark, extra)), "id")
    assert got == [
        (1, "Apple", "13 Pro"),
        (2, "Apple", "13"),
        (3, "Apple", "13 Max"),
        (4, "Apple", None),
        (5, "Samsung", "A02"),
        (6, "Samsung", "A02"),
        (7, "Samsung", "Dot"),
        (8, "One", "7"),
        (9, "Google", None),
        (11, "Samsung", "13"),
        (12, "Apple", "M0"),
    ]
    branded = m.attach_brand(texts, brands(spark))
    found = rows(m.detect_model(branded, models(spark, extra)), "id", "brand")
    assert found == sorted([r for r in got if r[2]] + [(8, "OnePlus", "7")])


def test_indexed_equals_brute_force(spark, rows):
    """Random word patterns, more than one literal block, with optional letters and genuine regexes."""
    rng = random.Random(3)
    parts = ["a", "b", "ab", "1", "12", "2", "x9", "9"]
    patterns = set()
    while len(patterns) < 150:
        words = rng.choices(parts, k=rng.randint(1, 4))
        if rng.random() < 0.2:
            words[-1] += "z?"
        patterns.add(r"\b" + r"\s*".join(words) + r"\b")
    patterns |= {r"\b(a|b)\s*12\b", r"\bx.\b", r"\ba-b\b", r"\b0?\s*a\b", r"\b[ab]+\b"}
    dictionary = [(f"p{i}", p) for i, p in enumerate(sorted(patterns))]
    texts = []
    for i in range(400):
        words = rng.choices(parts + ["az", "12z", "q", "bz"], k=rng.randint(0, 9))
        texts.append((i, " ".join(words)))
    want = sorted(
        (i, name, hit.start() + 1)
        for i, text in texts
        for name, p in dictionary
        if (hit := re.search(p, text, re.ASCII))
    )
    got = m.first_matches(
        frame(spark, texts, "id bigint, text string"), frame(spark, dictionary, "name string, pattern string"), ["name"]
    )
    assert rows(got, "id", "name") == sorted(want)


def test_bad_pattern_is_refused(spark):
    with pytest.raises(Exception, match="Unclosed group|PATTERN"):
        m.require_valid_patterns(frame(spark, [("x", "(")], "brand string, pattern string"))


def test_empty_dictionary(spark, rows):
    texts = frame(spark, [(1, "iphone")], "id bigint, text string")
    none = brands(spark).limit(0)
    assert rows(m.detect_brand(texts, none)) == []
    no_models = models(spark, 0).limit(0)
    assert rows(m.brand_model(texts, brands(spark), no_models)) == [(1, "Apple", None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_brand_detection_does_not_shuffle(spark):
    texts = spark.range(100).select("id", F.lit("my iphone").alias("text"))
    plan = plan_of(m.attach_brand(texts, brands(spark)))
    assert "Exchange" not in plan and "Join" not in plan


def test_model_detection_is_no_nested_loop(spark):
    texts = spark.range(100).select("id", F.lit("my iphone 13").alias("text"))
    plan = plan_of(m.brand_model(texts, brands(spark), models(spark, 100)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("hashpartitioning(id") == 1


def test_without_broadcasts(spark, rows):
    """A lookup too large to broadcast shuffles both sides; the rows are the same."""
    texts = frame(spark, MODEL_TEXTS, "id bigint, text string")
    want = rows(m.brand_model(texts, brands(spark), models(spark, 100), keep_all=True), "id")
    assert [r[0] for r in want] == [t[0] for t in MODEL_TEXTS]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = m.brand_model(texts, brands(spark, 100), models(spark, 100), keep_all=True)
        assert "SortMergeJoin" in plan_of(wide)
        assert rows(wide, "id") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_word_and_repeated_words(spark, rows):
    """One word in every text and many times in one: each text counts a model once."""
    texts = spark.range(3000).select("id", F.lit("iphone 13 " + "13 " * 50).alias("text"))
    got = m.brand_model(texts, brands(spark), models(spark, 100)).groupBy("brand", "model").count()
    assert rows(got) == [("Apple", "13", 3000)]


@pytest.mark.parametrize("filler", [0, 100])
def test_same_rows_with_and_without_filler(spark, rows, filler):
    """Entries count, not brands, and every pattern runs, whatever the size of the dictionary."""
    entries = [
        ("Apple", r"\bapple\b"), ("Apple", r"\biphone\b"), ("Apple", r"\biphone\b"), ("Samsung", r"\bgalaxy\b"),
        ("Google", r"\bpixel\b"), ("FB", r"\bfoo-bar\b"),
    ] + [(f"none{k}", rf"\bnone{k}\b") for k in range(filler)]
    dictionary = frame(spark, entries, "brand string, pattern string")
    texts = frame(spark, [(1, "apple iphone galaxy pixel"), (2, "foo-bar apple"), (3, "iphone")], "id bigint, text string")
    assert rows(m.detect_brand(texts, dictionary), "id") == [(2, "FB"), (3, "Apple")]
    assert rows(m.multi_brand(texts, dictionary), "id") == [(1, 5)]
    assert rows(m.first_matches(texts, dictionary, ["brand"]), "id", "match_pos", "brand") == [
        (1, "Apple", 1), (1, "Apple", 7), (1, "Apple", 7), (1, "Samsung", 14), (1, "Google", 21),
        (2, "FB", 1), (2, "Apple", 9), (3, "Apple", 1), (3, "Apple", 1),
    ]


def test_many_regexes_read_the_texts_once_more(spark, rows):
    entries = [(f"r{k}", rf"\bx{k}[a-c]+\b") for k in range(1025)] + [("w", r"\bplain\b")]
    texts = spark.range(30).selectExpr("id", "concat('x', id, 'ab plain') as text")
    got = m.dictionary_hits(texts, frame(spark, entries, "name string, pattern string"), ["name"])
    assert rows(got.groupBy("name").count(), "name")[:2] == [("r0", 1), ("r1", 1)]
    assert got.filter("name = 'w'").count() == 30
    assert plan_of(got).count("Range (0, 30") <= 2


def test_many_entries_are_counted_by_their_numbers(spark, rows, monkeypatch):
    asked, plain = [], m.dictionary_hits
    monkeypatch.setattr(m, "dictionary_hits", lambda texts, entries, fields: asked.append(fields) or plain(texts, entries, fields))
    entries = [(f"Filler{k}", rf"\bfiller{k}\b") for k in range(80)] + [("Filler1", r"\bfiller1\b"), ("Other", r"\bfiller1\b")]
    texts = frame(spark, [(1, "filler1 filler2 filler1"), (2, "filler2 filler3")], "id long, text string")
    assert rows(m.multi_brand(texts, frame(spark, entries, "brand string, pattern string"), max_brands=3), "id") == [(1, 4)]
    assert asked == [["entry", "times"]]  # what is shuffled with each hit: no names, no patterns


ODD_TEXTS = [
    (1, "x red widget y"), (2, "redwidget 12"), (3, "red\twidget"), (4, None), (5, ""), (6, "red widgets 1 2"), (7, "bored widget red  widget"),
    (8, "1 2 12"), (9, "12 red widget 12"), (10, "s20 s2"), (11, "x"), (12, "s 2"),
]


def test_plain_words_in_the_row(spark):
    """Words looked for before their pattern, beside patterns of other forms: what brute force finds, blanks of any kind, no text and repeats included."""
    patterns = [r"\bred\s*widget\b", r"\b12\b", r"\b1\s*2\b", r"\bs20?\b", "wid.et", r"\bred\s*widget\b"]
    entries = [(f"b{k}", p) for k, p in enumerate(patterns)]
    texts = spark.createDataFrame(ODD_TEXTS, "id int, text string")
    dictionary = spark.createDataFrame(entries, "brand string, pattern string")
    want = sorted((i, b, hit.start() + 1) for i, t in ODD_TEXTS for b, p in entries if t is not None and (hit := re.search(p, t)))
    assert sorted(map(tuple, m.first_matches(texts, dictionary, ["brand"]).collect())) == want
    on = texts.withColumn("brand", F.concat(F.lit("b"), (F.col("id") % 3).cast("string")))
    hits = m.dictionary_hits(on, dictionary.withColumn("n", F.lit(1)), ["n"], on=["brand"])
    assert sorted((r.id, r.brand) for r in hits.collect()) == sorted((i, b) for i, b, _ in want if b == f"b{i % 3}")


def test_hits_are_found_once(spark):
    """No filter before the unnesting, which would find all hits, or make all runs of words, once more."""
    texts = spark.createDataFrame(ODD_TEXTS, "id int, text string")
    few = spark.createDataFrame([("a", r"\bred\s*widget\b"), ("b", "wid.et")], "brand string, pattern string")
    many = spark.createDataFrame([(f"b{k}", rf"\bw{k}\s*x\b") for k in range(80)], "brand string, pattern string")
    for found in (
        m.first_matches(texts, few, ["brand"]), m.detect_brand(texts, few), m.dictionary_hits(texts, few, ["brand"]),
        m.dictionary_hits(texts, many, ["brand"]),
    ):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.split("\n") if "Filter" in x and "size(" in x and "pattern#" not in x]  # the dictionary is cut into words, too


def test_word_runs(spark):
    texts = frame(spark, [(1, "a"), (2, "a b c"), (3, ""), (4, "a b c d e")], "id int, text string")
    got = texts.select("id", m.word_runs(F.split("text", " "), 3).alias("runs"))
    for r in got.join(texts, "id").collect():
        words = r.text.split(" ")
        assert [tuple(x) for x in r.runs] == [(i, " ".join(words[i : i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    assert "array_join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_hits_of_texts_are_combined_by_hash(spark):
    texts = frame(spark, [(1, "apple one two"), (2, "nothing")], "id int, text string")
    models = frame(spark, [("Apple", "One", r"\bone\b", 3), ("Apple", "Two", r"\btwo\b", 3)], "brand string, model string, pattern string, length int")
    found = m.brand_model(texts, brands(spark), models, keep_all=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[id#\d+, brand#", plan.replace("SortAggregate", "Sorted")) and not re.search(r"SortAggregate\(key=\[id#\d+, brand#", plan)
    assert sorted(map(tuple, found.collect())) == [(1, "Apple", "One"), (2, None, None)]
