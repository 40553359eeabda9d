from datetime import date

import pytest
from pyspark.sql import functions as F

from mercato.functions import text as t
from mercato.operators.storage import storage_gb


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "value, want",
    [
        (None, None),
        ("   ", ""),
        ("  iPhone\t13 \n Pro ", "iphone 13 pro"),
        ("S20+5G", "s20 plus 5g"),
        ("Étui Pokémon", "tui pok mon"),
        ("nice phone Tags: cheap, new", "nice phone"),
        ("Stage vintage item", "stage vintage item"),
    ],
)
def test_norm_text(spark, value, want):
    assert one(spark, value, t.norm_text) == want


def test_exploration_variant_cuts_inside_words(spark):
    assert one(spark, "Stage vintage item", t.norm_text_at_tag) == "s"
    assert one(spark, "S20+5G", t.norm_text_at_tag) == "s20 plus5g"


def test_to_pattern_and_split(spark):
    assert one(spark, "S20+  FE", t.to_pattern) == r"\bs20\s*plus\s*fe\b"
    assert one(spark, "Moto G7s", lambda c: t.squeeze(t.split_word(c, r"([a-z]*)(\d+)(s?)", 3))) == "Moto G 7 s"
    assert one(spark, "Razr", lambda c: t.split_word(c, r"([a-z]*)(\d+)(s?)", 3)) == "Razr"


def test_numbers_in(spark):
    assert one(spark, "Showing 1 - 40 of 1,234 results", t.numbers_in) == [1, 40, 1234]


def test_row_hash_marks_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "null")], "x string, y string")
    first, second = [r[0] for r in df.select(t.row_hash("x", "y")).collect()]
    assert first == second  # known ambiguity, kept


@pytest.mark.parametrize("days, want", [(-1, "all"), (0, "daily"), (1, "daily"), (7, "7")])
def test_file_names(spark, days, want):
    name = f"02-01-2026-{want}-cell.json"
    assert t.file_name(date(2026, 1, 2), "cell", days) == name
    col = t.file_name_column(F.lit(date(2026, 1, 2)), F.lit("cell"), F.lit(days))
    assert spark.range(1).select(col).first()[0] == name


@pytest.mark.parametrize(
    "text, want",
    [
        ("iphone 128 gb", 128),
        ("1tb 8gb", 1024),
        ("8gb ram 256gb", 256),
        ("000gb", None),
        ("0128gb", 128),
        ("64go", 64),
        ("5g", None),
        ("6g phone", 6),
        ("256 g", 256),
        ("pixel 7 pro", None),
        ("12gigs 64gib", 64),
        ("", None),
        (None, None),
    ],
)
def test_storage(spark, text, want):
    assert one(spark, text, storage_gb) == want


def test_storage_equals_ranked_join(spark):
    """The row-local form against matching every text with every pattern."""
    import random
    import re

    from mercato.constants import STORAGE_PATTERNS

    rng = random.Random(5)
    words = ["128", "64", "0", "00", "1", "9", "1024", "gb", "gigs", "gib", "go", "g", "tb", "8gb", "32gb", "2tb", "x", "512g"]
    texts = [" ".join(rng.choices(words, k=6)).replace(" g", rng.choice([" g", "g"])) for _ in range(3000)]

    def brute(text):
        for unit, pattern in STORAGE_PATTERNS:
            m = re.search(pattern, text)
            if m:
                return int(m.group(1)) * (1024 if unit == "TB" else 1)
        return None

    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r[0]: r[1] for r in df.select("i", storage_gb(F.col("text"))).collect()}
    assert got == {i: brute(x) for i, x in enumerate(texts)}
