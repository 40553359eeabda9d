"""Catalogue and dictionary tables: cleaning them, and deriving patterns from a product catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.constants import BRAND_ALIASES, FOCUS_BRANDS, MODEL_RULES, PLAIN_BRANDS
from mercato.functions.text import compact_length, split_word, squeeze, to_pattern
from mercato.operators.dedup import drop_missing, keep_first


def clean_brands(raw: DataFrame) -> DataFrame:
    """Unique brand, then unique pattern."""
    rows = drop_missing(raw.withColumn("brand", squeeze(F.col("brand"))), "brand", "pattern")
    rows = keep_first(rows, ["brand"], ["pattern"])
    return keep_first(rows, ["pattern"], ["brand"]).select("brand", "pattern")


def clean_catalogue(raw: DataFrame) -> DataFrame:
    """Unique (brand, model)."""
    rows = raw.withColumns({c: squeeze(F.col(c)) for c in ("brand", "model")})
    return keep_first(drop_missing(rows, "brand", "model"), ["brand", "model"], ["url"]).select(
        "brand", "model", "url"
    )


def clean_models(raw: DataFrame) -> DataFrame:
    """Unique (brand, model), then unique (brand, pattern)."""
    rows = raw.withColumns(
        {
            "brand": squeeze(F.col("brand")),
            "model": squeeze(F.col("model")),
            "length": F.col("length").try_cast("int"),
        }
    )
    rows = drop_missing(rows, "brand", "model", "pattern").filter("length IS NOT NULL")
    rows = keep_first(rows, ["brand", "model"], ["pattern", "length", "url"])
    rows = keep_first(rows, ["brand", "pattern"], ["model", "length", "url"])
    return rows.select("brand", "model", "pattern", "length", "url")


def focus(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(F.col("brand").isin(FOCUS_BRANDS))


def own_name_patterns(names: DataFrame) -> DataFrame:
    """(brand, pattern) matching each brand by its own lower-case name."""
    word = F.concat(F.lit(r"\b"), F.lower("brand"), F.lit(r"\b"))
    return names.select("brand", word.alias("pattern"))


def alias_dictionary(spark: SparkSession) -> DataFrame:
    plain = own_name_patterns(spark.createDataFrame([(b,) for b in PLAIN_BRANDS], "brand string"))
    aliases = spark.createDataFrame(list(BRAND_ALIASES.items()), "brand string, pattern string")
    return plain.unionByName(aliases)


def _clean(name: Column, steps: list[tuple]) -> tuple[Column, Column]:
    """(model name, whether the row stays) after the `clean` steps of a brand."""
    stays = F.lit(True)
    for kind, *args in steps:
        if kind == "discard":
            stays &= ~name.rlike(args[0])
        elif kind == "keep":
            stays &= name.rlike(args[0])
        elif kind == "erase":
            name = F.regexp_replace(name, args[0], "")
        elif kind == "erase_literal":
            name = F.replace(name, F.lit(args[0]), F.lit(""))
        elif kind == "squeeze":
            name = squeeze(name)
        elif kind == "name_blank":
            name = F.when(name == "", args[0]).otherwise(name)
        elif kind == "refuse":
            stays &= name != args[0]
    return name, stays


def _shape(name: Column, steps: list[tuple]) -> Column:
    for kind, *args in steps:
        if kind == "split":
            name = split_word(name, *args)
        elif kind == "swap":
            name = F.regexp_replace(name, *args)
        elif kind == "squeeze":
            name = squeeze(name)
    return to_pattern(name)


def _by_brand(choices: dict[str, Column]) -> Column:
    """CASE over the brand column."""
    first, *rest = choices.items()
    start = F.when(F.col("brand") == first[0], first[1])
    return reduce(lambda case, kv: case.when(F.col("brand") == kv[0], kv[1]), rest, start)


def model_dictionary(catalogue: DataFrame) -> DataFrame:
    """(brand, model, url, pattern, length) by the rules of each brand: one pass over the catalogue and
    one exchange for all brands. Of equal model names the first catalogue name stays."""
    cleaned = {b: _clean(F.col("name"), rule["clean"]) for b, rule in MODEL_RULES.items()}
    rows = (
        catalogue.filter(F.col("brand").isin(list(MODEL_RULES)))
        .select("brand", F.col("model").alias("name"), "url")
        .filter(_by_brand({b: stays for b, (_, stays) in cleaned.items()}))
        .withColumn("model", _by_brand({b: name for b, (name, _) in cleaned.items()}))
    )
    rows = keep_first(rows, ["brand", "model"], ["name", "url"])
    shaped = {b: _shape(F.col("model"), rule["shape"]) for b, rule in MODEL_RULES.items()}
    return rows.select(
        "brand",
        "model",
        "url",
        _by_brand(shaped).alias("pattern"),
        compact_length(F.col("model")).alias("length"),
    )
