"""Names that occur in a text with a few letters changed: an approximate join of word runs and names.

A run of words matches a name where their edit distance is at most a tenth of the longer one's length. Within d edits, one of d + 1 pieces of
a name must stand in the run unchanged, moved by at most d places; so names are looked up by their pieces, and what an
equi join of pieces finds is verified by a banded edit distance. Runs are made distinct before they are cut, and only lengths that
names have are tried. Names and texts are normalised (a-z, 0-9, single spaces)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.constants import MAX_BRANDS_PER_AD, MODEL_HITS_TO_REJECT
from mercato.functions.text import norm_text
from mercato.operators import matching
from mercato.sources.tables import stage

#: Edits allowed: one in so many letters of the longer string (similarity of 90 %).
LETTERS_PER_EDIT = 10
OTHER = "Other"


def edits(name_length: Column) -> Column:
    """The most edits that a partner of a name of that length can be away."""
    longest = F.floor(name_length * LETTERS_PER_EDIT / (LETTERS_PER_EDIT - 1))
    return F.floor(longest / LETTERS_PER_EDIT).cast("int")


def _piece(n: Column, d: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and end of piece i of d + 1 of a name of length n."""
    return F.floor(i * n / (d + 1)).cast("int"), F.floor((i + 1) * n / (d + 1)).cast("int")


def name_pieces(names: DataFrame, on: Sequence[str]) -> DataFrame:
    """(*on, name, n, i, piece) of names (*on, name)."""
    n = F.length("name")
    with_d = names.select(*on, "name", n.alias("n"), edits(n).alias("d")).filter("n > 0")
    each = with_d.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    start, end = _piece(F.col("n"), F.col("d"), F.col("i"))
    return each.select(*on, "name", "n", "i", F.substring("name", start + 1, end - start).alias("piece"))


def run_pieces(runs: DataFrame, lengths: Sequence[int], on: Sequence[str]) -> DataFrame:
    """(*on, run, n, i, piece): what a run has to have in common with a name of length n, for all lengths that names have."""
    size, known = F.length("run"), F.array(*map(F.lit, lengths))
    # |n - size| <= a tenth of the longer
    near = F.filter(known, lambda n: LETTERS_PER_EDIT * F.abs(n - size) <= F.greatest(n, size))
    each = runs.select(*on, "run", F.explode(near).alias("n")).withColumn("d", edits(F.col("n")))
    each = each.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    start, end = _piece(F.col("n"), F.col("d"), F.col("i"))
    each = each.withColumn("length", end - start).withColumn("at", F.explode(F.sequence(start - F.col("d"), start + F.col("d"))))
    each = each.filter((F.col("at") >= 0) & (F.col("at") + F.col("length") <= size))
    return each.select(*on, "run", "n", "i", F.substring("run", F.col("at") + 1, F.col("length")).alias("piece"))


def similar(texts: DataFrame, names: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """(id, *on, name, similarity): every name within a tenth of a run of words of a text (id, *on, text), with the best similarity."""
    names = stage(names.select(*on, "name").distinct(), "fuzzy-names")
    words = F.size(F.split("name", " "))
    size = names.agg(F.max(words).alias("words"), F.max(edits(F.length("name"))).alias("d"), F.sort_array(F.collect_set(F.length("name"))).alias("n")).first()
    lengths = [n for n in size.n if n]  # distinct lengths of names
    if not lengths:
        return texts.limit(0).select("id", *on, F.lit("").alias("name"), F.lit(0.0).alias("similarity"))
    # split before, not once more for each run; "outer", because Spark would make all runs once more, to leave out texts without any beforehand
    tokens = texts.select("id", *on, F.split("text", " ").alias("tokens"))
    runs = tokens.select("id", *on, F.inline_outer(matching.word_runs(F.col("tokens"), size.words + size.d))).filter("run IS NOT NULL").select("id", *on, "run").distinct()
    runs = runs.filter((F.length("run") * LETTERS_PER_EDIT >= lengths[0] * (LETTERS_PER_EDIT - 1)) & (F.length("run") * (LETTERS_PER_EDIT - 1) <= lengths[-1] * LETTERS_PER_EDIT))
    runs = stage(runs, "fuzzy-runs")
    pieces = run_pieces(runs.select(*on, "run").distinct(), lengths, on)
    tried = pieces.join(name_pieces(names, on), [*on, "n", "i", "piece"]).select(*on, "run", "name").distinct()
    longer = F.greatest(F.length("run"), F.length("name"))
    most = int(size.d)
    apart = tried.withColumn("edits", F.levenshtein("run", "name", most)).filter((F.col("edits") >= 0) & (F.col("edits") * LETTERS_PER_EDIT <= longer))
    scored = apart.select(*on, "run", "name", (1 - F.col("edits") / longer).alias("similarity"))
    return runs.join(scored, [*on, "run"]).groupBy("id", *on, "name").agg(F.max("similarity").alias("similarity"))


def best(texts: DataFrame, names: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """(id, *on, name, similarity): of each text (and ``on``) the most similar name, the first by name of equals."""
    rank = F.min(F.struct((-F.col("similarity")).alias("less"), F.col("name"))).alias("x")
    found = similar(texts, names, on).groupBy("id", *on).agg(rank)
    return found.select("id", *on, "x.name", (-F.col("x.less")).alias("similarity"))


def _named(dictionary: DataFrame, column: str, on: Sequence[str] = ()) -> DataFrame:
    """(*on, name, column): normalised names; of several that are the same the first."""
    return dictionary.select(*on, norm_text(F.col(column)).alias("name"), column).filter("name <> ''").groupBy(*on, "name").agg(F.min(column).alias(column))


def brand_model(
    texts: DataFrame,
    brands: DataFrame,
    models: DataFrame,
    max_brands: int = MAX_BRANDS_PER_AD,
    reject_at: int = MODEL_HITS_TO_REJECT,
    other: str | None = OTHER,
) -> DataFrame:
    """(id, brand, model, brand_similarity, model_similarity) of every text (id, text): by the patterns; where none of a brand is found, by a
    name of a brand that is nearly in the text, then the brand's model patterns; where none of these is found, by a name of a model of the brand. What
    is not found either way is ``other`` (similarity NULL). A text with too many brands is rejected: NULL."""
    texts = stage(texts.select("id", "text"), "fuzzy-texts")
    exact = matching.attach_brand(texts, brands, max_brands)
    many = stage(matching.multi_brand(texts, brands, max_brands).select("id"), "fuzzy-many")
    exact = stage(exact.select("id", "text", "brand").distinct(), "fuzzy-exact")
    without = texts.join(exact.select("id"), "id", "left_anti").join(many, "id", "left_anti")
    nearly = best(without, _named(brands, "brand").select("name")).join(_named(brands, "brand"), "name").select("id", "brand", "similarity")
    branded = exact.withColumn("brand_similarity", F.lit(1.0)).unionByName(
        texts.join(nearly, "id").select("id", "text", "brand", F.col("similarity").alias("brand_similarity"))
    )
    branded = stage(branded, "fuzzy-branded")
    plain = branded.select("id", "text", "brand")
    hits = stage(matching.dictionary_hits(plain, models, ["model", "length"], on=["brand"]), "fuzzy-hits")
    by_pattern = matching.longest_models(hits, reject_at).withColumn("model_similarity", F.lit(1.0))
    names = _named(models, "model", ["brand"])
    by_name = best(plain.join(hits.select("id").distinct(), "id", "left_anti"), names.select("brand", "name"), ["brand"]).join(names, ["brand", "name"])
    by_name = by_name.select("id", "brand", "model", F.col("similarity").alias("model_similarity"))
    found = branded.drop("text").join(by_pattern.unionByName(by_name), ["id", "brand"], "left")
    # a model before none, the more similar before the less, then by name
    rank = F.struct(
        F.col("model").isNull().alias("_none"), (-F.col("model_similarity")).alias("_model"), (-F.col("brand_similarity")).alias("_brand"), "brand", "model",
    )
    one = found.groupBy("id").agg(F.min(rank).alias("x")).select("id", "x.*")
    rows = texts.select("id").join(one, "id", "left").join(many.withColumn("_many", F.lit(True)), "id", "left")
    fill = F.when(F.col("_many").isNull(), F.lit(other))
    return rows.select(
        "id", F.coalesce("brand", fill).alias("brand"), F.coalesce("model", fill).alias("model"),
        (-F.col("_brand")).alias("brand_similarity"), (-F.col("_model")).alias("model_similarity"),
    )
