import pytest

ODD = [
    (1, "a b c", "en", "s"), (2, None, "en", "s"), (3, "", None, None), (4, "   \n\t ", "de", "s"), (5, "x " * 3000, "en", "s"),
    (6, "a b c", "en", "s"), (6, "a b c", "en", "s"), (None, "a b c d", "en", "t"), (8, "Ä b \x1c c 🙂 d'll  e\r\n", "fr", "t"),
    (9, " ".join(f"w{k}" for k in range(60)), "en", "s"), (10, "up " + " ".join(f"w{k}" for k in range(60)), "en", "s"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows, and columns whose names clash with results."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    clash = ["n_words", "score", "kept", "toxicity", "copy_no", "shuffle_key", "rate", "kept_text", "n_removed", "component_id", "block"]
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("mine") for c in clash}).cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(k, 1, 0) for k in range(1, 11)] + [(1, None, None), (6, 0, 1), (999, 1, 1)], "doc_id long, quality int, toxic int"
    )
