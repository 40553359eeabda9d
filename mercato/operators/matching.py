"""Regex dictionaries against listing texts, without pairing every text with every pattern.

Two plans with the same rows, chosen by the size of the dictionary:

* few patterns: each becomes a literal expression of the row, compiled once, no shuffle;
* many patterns: patterns made of plain words (``\\bs20\\s*plus\\b``) are looked up by an equi join of
  the word runs of a text with the words of the pattern, each hit then checked by the pattern itself. Other regexes are
  looked up by a trigram that each of their matches must have (see factors), and tried on the texts that have it. Only regexes without such
  a string are literals of one pass over all texts.

A text is rejected by the number of dictionary entries found in it, so several patterns of a brand, or one twice, count each.

Texts must be normalised (a-z, 0-9, single spaces), which is what makes the word lookup exact.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mercato.constants import MAX_BRANDS_PER_AD, MODEL_HITS_TO_REJECT
from mercato.functions.text import listing_text, row_hash
from mercato.operators.factors import NEEDED, certain, chosen_grams, text_grams
from mercato.sources.tables import stage

#: A pattern of plain words, and what its \\s stands for.
_PLAIN, _BLANKS = re.compile(r"\\b[a-z0-9]+(?:\\s\*[a-z0-9]+)*\\b"), " \t\n\x0b\f\r"
BLOCK = 64  # up to so many patterns are matched in the row, without a lookup


def literal_hits(text: Column, entries: Sequence[Row], fields: Sequence[str], on: Sequence[str] = ()) -> Column:
    """The entries whose pattern occurs in the text, with the 1-based position of the first match. A pattern of plain words is tried only where
    its letters follow each other in the text without its blanks, as they do in every match: a search for a string costs far less than a regex.
    To be unnested by ``explode_outer``: before an ``explode`` Spark filters by the size of the array, and finds all once more for that."""
    plain = [e for e in entries if _PLAIN.fullmatch(e["pattern"] or "")]
    others = [e for e in entries if not _PLAIN.fullmatch(e["pattern"] or "")]

    def entry(e: Row, *more: Column) -> Column:
        return F.struct(*[F.lit(e[f]).alias(f) for f in fields], *more)

    def tried(own: Column) -> Column:
        known = F.array(*[
            entry(e, F.lit(e["pattern"]).alias("_pattern"), F.lit(e["pattern"].replace(r"\s*", "")[2:-2]).alias("_close"),
                  *[F.lit(e[c]).alias(f"_on{k}") for k, c in enumerate(on)])
            for e in plain
        ])
        near = F.filter(
            known, lambda e: reduce(lambda a, b: a & b, [F.col(c) == e[f"_on{k}"] for k, c in enumerate(on)] + [F.contains(own["close"], e["_close"])])
        )
        return F.transform(near, lambda e: F.struct(*[e[f].alias(f) for f in fields], F.regexp_instr(own["text"], e["_pattern"]).alias("pos")))

    found = []
    if plain:  # bound once, as the element of a one-element array
        own = F.struct(text.alias("text"), F.translate(text, _BLANKS, "").alias("close"))
        found.append(F.element_at(F.transform(F.array(own), tried), 1))
    if others:
        pos = [F.regexp_instr(text, F.lit(e["pattern"])) for e in others]
        same = [reduce(lambda a, b: a & b, [F.col(c) == F.lit(e[c]) for c in on], F.lit(True)) for e in others]
        found.append(F.array(*[entry(e, (F.when(s, p).otherwise(0) if on else p).alias("pos")) for e, s, p in zip(others, same, pos)]))
    return F.filter(F.concat(*found) if len(found) > 1 else found[0], lambda h: h["pos"] > 0)


def read_small(dictionary: DataFrame, limit: int) -> list[Row] | None:
    """The rows of a dictionary of at most ``limit`` entries; None beyond, after reading limit + 1."""
    rows = dictionary.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def pattern_words(pattern: Column) -> Column:
    """The words of a plain pattern as array<string> of alternatives (an optional letter ``0?`` gives
    two); NULL for any other pattern, which only the regex itself can match."""
    body = F.regexp_extract(pattern, r"^\\b(.+)\\b$", 1)
    words = F.regexp_replace(body, r"\\s\*", " ")
    optional_word = words.rlike(r"(^| )([a-z0-9]\?)+( |$)")
    variants = F.array(words)
    for _ in range(2):
        variants = F.flatten(
            F.transform(
                variants,
                lambda w: F.array(
                    F.regexp_replace(w, r"^([^?]*)[a-z0-9]\?", "$1"),
                    F.regexp_replace(w, r"^([^?]*[a-z0-9])\?", "$1"),
                ),
            )
        )
    variants = F.array_distinct(variants)
    plain = F.forall(variants, lambda w: w.rlike(r"^[a-z0-9]+( [a-z0-9]+)*$"))
    return F.when(~optional_word & plain, variants)


def word_runs(text: Column, longest: int) -> Column:
    """Every run of 1 to ``longest`` words as array<struct<tok, run>>; ``tok`` counts words from 0."""
    n = F.size(text)

    def runs(k: int) -> Column:
        if k == 1:
            return F.transform(text, lambda t, i: F.struct(i.alias("tok"), t.alias("run")))
        # the words behind each word, put together one by one: far cheaper than to cut and join an array for each run
        def run(t: Column, i: Column) -> Column:
            more = [x for j in range(1, k) for x in (F.lit(" "), F.get(text, i + j))]
            return F.struct(i.alias("tok"), F.concat(t, *more).alias("run"))

        return F.slice(F.transform(text, run), F.lit(1), F.greatest(n - (k - 1), F.lit(0)))

    return F.concat(*[runs(k) for k in range(1, longest + 1)])


def _typed_nulls(dictionary: DataFrame, fields: Sequence[str]) -> list[Column]:
    return [F.lit(None).cast(dictionary.schema[f].dataType).alias(f) for f in fields] + [
        F.lit(None).cast("int").alias("tok"),
        F.lit(None).cast("int").alias("off"),
    ]


def _literal_pass(
    texts: DataFrame,
    entries: list[Row],
    fields: Sequence[str],
    on: Sequence[str],
    keep_all: bool,
    carry: Sequence[str],
) -> DataFrame:
    hits = literal_hits(F.col("text"), entries, fields, on)
    before = F.substring("text", F.lit(1), F.col("h.pos") - 1)
    rows = texts.select("id", *carry, *on, "text", F.explode_outer(hits).alias("h"))
    return (rows if keep_all else rows.filter("h IS NOT NULL")).select(
        "id",
        *carry,
        *on,
        *[F.col(f"h.{f}") for f in fields],
        (F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))).alias("tok"),
        F.length(F.substring_index(before, " ", -1)).alias("off"),
    )


def _indexed_pass(
    texts: DataFrame,
    plain: DataFrame,
    longest: int,
    fields: Sequence[str],
    on: Sequence[str],
    keep_all: bool,
    carry: Sequence[str],
) -> DataFrame:
    lookup = plain.withColumn("words", F.replace("words", F.lit(" "), F.lit("")))
    runs = word_runs(F.col("tokens"), longest)
    if keep_all:  # one more run per text that no word equals, its own so that these rows spread out
        own = F.concat(F.lit("#"), F.col("id").cast("string"))
        runs = F.concat(runs, F.array(F.struct(F.lit(-1).alias("tok"), own.alias("run"))))
    runs = (
        texts.select("id", *carry, *on, F.split("text", " ").alias("tokens"))
        # "outer", because Spark would make all runs once more, to leave out texts without any beforehand
        .select("id", *carry, *on, F.inline_outer(runs))
        .filter("run IS NOT NULL")
        .withColumn("words", F.replace("run", F.lit(" "), F.lit("")))
    )
    # No hint: Spark broadcasts the lookup where its size allows and shuffles both sides beyond,
    # splitting the partitions of frequent words.
    fits = F.regexp_like("run", F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")$")))
    if keep_all:
        found = runs.join(lookup, [*on, "words"], "left").filter((F.col("tok") < 0) | fits)
    else:
        found = runs.join(lookup, [*on, "words"], "inner").filter(fits)
    return found.select("id", *carry, *on, *fields, "tok", F.lit(0).alias("off"))


#: Columns of a lookup with what a text must have besides the trigram for the entry to be tried.
_NEEDS = [f"_need{k}" for k in range(NEEDED)]


def factor_candidates(texts: DataFrame, lookup: DataFrame, on: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Texts with the entries of a lookup whose trigram, and whose other strings, they have: all that can match, once per trigram. The lookup
    was made on the driver, so it is what is broadcast, never the texts."""
    grams = texts.select("id", *carry, *on, "text", F.explode(text_grams(F.col("text"))).alias("gram"))
    return grams.join(F.broadcast(lookup), [*on, "gram"]).filter(_has_all(lookup)).drop(*_NEEDS)


def _has_all(lookup: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [F.contains("text", n) for n in _NEEDS if n in lookup.columns], F.lit(True))


def _regex_pass(
    texts: DataFrame, regexes: list[Row], dictionary: DataFrame, fields: Sequence[str], on: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """Regexes in one pass over the texts: those with a trigram tried where it is, by a join, the others on every text, in the row. An entry comes
    once per trigram of its that a text has."""
    grams = chosen_grams([r["pattern"] for r in regexes])
    rest = [r for r, own in zip(regexes, grams) if own is None]
    known = [(*(r[c] for c in dictionary.columns), g, *certain(r["pattern"])) for r, own in zip(regexes, grams) for g in own or ()]
    if not known:
        return _literal_pass(texts, rest, fields, on, False, carry)
    strings = [StructField(c, StringType()) for c in ("gram", *_NEEDS)]
    lookup = texts.sparkSession.createDataFrame(known, StructType([*dictionary.schema.fields, *strings]))
    if rest:
        hits = literal_hits(F.col("text"), rest, fields, on)
        own = F.transform(hits, lambda h: F.struct(F.lit(None).cast("string").alias("gram"), h.alias("hit")))
        tries = F.transform(text_grams(F.col("text")), lambda g: F.struct(g.alias("gram"), F.get(F.slice(hits, 1, 0), F.lit(0)).alias("hit")))
        rows = texts.select("id", *carry, *on, "text", F.inline(F.concat(own, tries)))
        lookup = lookup.select(*on, "gram", "pattern", F.struct(*fields).alias("_entry"), *_NEEDS)
        tried = rows.join(F.broadcast(lookup), [*on, "gram"], "left").filter(F.col("hit").isNotNull() | (F.col("pattern").isNotNull() & _has_all(lookup)))
        found = [F.coalesce(F.col(f"hit.{f}"), F.col(f"_entry.{f}")).alias(f) for f in fields]
        tried = tried.select("id", *carry, *on, "text", "pattern", *found, F.col("hit.pos").alias("_pos"))
        pos = F.when(F.col("_pos").isNotNull(), F.col("_pos")).otherwise(F.regexp_instr("text", F.col("pattern")))
    else:
        tried, pos = factor_candidates(texts, lookup, on, carry), F.regexp_instr("text", F.col("pattern"))
    # unnested from an array, so that the regex runs once
    hits = tried.withColumn("pos", F.explode(F.array(pos))).filter("pos > 0")
    before = F.substring("text", F.lit(1), F.col("pos") - 1)
    return hits.select(
        "id", *carry, *on, *fields,
        (F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))).alias("tok"),
        F.length(F.substring_index(before, " ", -1)).alias("off"),
    )


def dictionary_hits(
    texts: DataFrame,
    dictionary: DataFrame,
    fields: Sequence[str],
    on: Sequence[str] = (),
    keep_all: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(id, *carry, *on, *fields, tok, off) for every dictionary entry found in a text ``(id, *on, text)``;
    an entry counts only for texts that agree on the ``on`` columns. (tok, off) orders the hits of a
    text by the position of the match: words before it, letters into its word. An entry found as
    several word runs or by several trigrams comes once per run. ``keep_all`` keeps texts without hits as a row of NULL
    fields (texts with hits may have such a row too). ``carry`` names columns of the texts to pass on."""
    dictionary = dictionary.select(*on, *fields, "pattern")
    indexed = dictionary.withColumn("words", pattern_words(F.col("pattern")))
    words_in = F.array_max(F.transform("words", lambda w: F.size(F.split(w, " "))))
    size = indexed.agg(
        F.count("*").alias("entries"),
        F.count_if(F.col("words").isNull()).alias("regexes"),
        F.max(words_in).alias("longest"),
    ).first()
    if size["entries"] == 0:
        rows = texts if keep_all else texts.limit(0)
        return rows.select("id", *carry, *on, *_typed_nulls(dictionary, fields))
    if size["entries"] <= BLOCK:
        return _literal_pass(texts, dictionary.limit(BLOCK).collect(), fields, on, keep_all, carry)
    plain = indexed.select(*on, *fields, "pattern", F.explode("words").alias("words"))
    found = _indexed_pass(texts, plain, size["longest"] or 1, fields, on, keep_all, carry)
    if not size["regexes"]:
        return found
    # a dictionary is written by people and read by the driver; documents never are
    regexes = indexed.filter("words IS NULL").drop("words").collect()
    return found.unionByName(_regex_pass(texts, regexes, dictionary, fields, on, carry))


def _entries(dictionary: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per distinct entry: fields, pattern, ``entry`` (its pattern once more, as a field) and ``times``."""
    counted = dictionary.groupBy(*fields, "pattern").agg(F.count("*").alias("times"))
    return counted.withColumn("entry", F.col("pattern"))


def first_matches(texts: DataFrame, dictionary: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(id, *fields, match_pos): every entry found in a text, with the 1-based position of its first
    match. This is the join of texts and dictionary on "the pattern occurs in the text"."""
    entries = read_small(dictionary.select(*fields, "pattern"), BLOCK)
    if entries:
        hits = literal_hits(F.col("text"), entries, fields)
        rows = texts.select("id", F.explode_outer(hits).alias("h")).filter("h IS NOT NULL")
        return rows.select("id", *[F.col(f"h.{f}") for f in fields], F.col("h.pos").alias("match_pos"))
    hits = dictionary_hits(texts, _entries(dictionary, fields), [*fields, "entry", "times"])
    first = hits.groupBy("id", *fields, "entry", "times").agg(F.min(F.struct("tok", "off")).alias("p"))
    first = first.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    before = F.length(F.expr("substring_index(text, ' ', p.tok)")) + 1
    pos = F.when(F.col("p.tok") > 0, before).otherwise(0) + F.col("p.off") + 1
    # both sides grow with the data, whatever size Spark takes the stored texts for
    return first.join(texts.hint("merge"), "id").select("id", *fields, pos.alias("match_pos"))


def multi_brand(texts: DataFrame, brands: DataFrame, max_brands: int = MAX_BRANDS_PER_AD) -> DataFrame:
    """(id, n_brands) of the texts rejected for naming too many brands."""
    entries = read_small(brands.select("brand", "pattern"), BLOCK)
    if entries:
        n = F.size(literal_hits(F.col("text"), entries, ["brand"])).cast("bigint")
        many = F.filter(F.array(n), lambda size: size > max_brands)
        return texts.select("id", F.explode_outer(many).alias("n_brands")).filter("n_brands IS NOT NULL")
    # an entry is known by a number, stored so that it stays the same: its name and pattern are not shuffled with each hit
    numbered = stage(_entries(brands, ["brand"]).withColumn("entry", F.monotonically_increasing_id()), "entries")
    hits = dictionary_hits(texts, numbered, ["entry", "times"])
    counted = hits.select("id", "entry", "times").distinct().groupBy("id").agg(F.sum("times").alias("n_brands"))
    return counted.filter(F.col("n_brands") > max_brands)


def require_valid_patterns(dictionary: DataFrame) -> None:
    """Fail now, not inside a long job, on a pattern that does not compile."""
    dictionary.agg(F.count_if(F.regexp_like(F.lit(""), F.col("pattern")))).first()


def listing_texts(listings: DataFrame) -> DataFrame:
    return listings.select(
        "id", listing_text(F.col("info.title"), F.col("info.description")).alias("text")
    )


def _leaders(hits: Column, max_brands: int) -> Column:
    """The brands, as structs, at the smallest position among the hits of a text; none of too many. The hits are
    bound once, as the element of a one-element array."""

    def pick(found: Column) -> Column:
        first = F.array_min(F.transform(found, lambda h: h["pos"]))
        names = F.transform(F.filter(found, lambda h: h["pos"] == first), lambda h: F.struct(h["brand"].alias("brand")))
        return F.when(F.size(found) <= max_brands, F.array_distinct(names))

    return F.element_at(F.transform(F.array(hits), pick), 1)


def attach_brand(
    texts: DataFrame, brands: DataFrame, max_brands: int = MAX_BRANDS_PER_AD, keep_all: bool = False
) -> DataFrame:
    """The columns of the texts and the brand named first; a row for each of several that start at the
    same place. Texts naming no brand, or more than ``max_brands``, are left out, or kept with a NULL
    brand (``keep_all``)."""
    entries = read_small(brands.select("brand", "pattern"), BLOCK)
    if entries:  # row-local: no shuffle
        leaders = _leaders(literal_hits(F.col("text"), entries, ["brand"]), max_brands)
        rows = texts.select("*", F.explode_outer(leaders).alias("_leader"))
        return (rows if keep_all else rows.filter("_leader IS NOT NULL")).select(*texts.columns, F.col("_leader.brand").alias("brand"))
    # entries found in one text: one row each, so a group is bounded by the dictionary
    of_text = Window.partitionBy("id")
    hits = dictionary_hits(texts, _entries(brands, ["brand"]), ["brand", "entry", "times"]).repartition("id")
    leaders = (
        hits.groupBy("id", "brand", "entry", "times")
        .agg(F.min(F.struct("tok", "off")).alias("place"))
        .withColumn("n", F.sum("times").over(of_text))
        .withColumn("first", F.min("place").over(of_text))
        .filter((F.col("n") <= max_brands) & (F.col("place") == F.col("first")))
    )
    joined = texts.join(leaders.select("id", "brand").distinct(), "id", "left" if keep_all else "inner")
    return joined.select(*texts.columns, "brand")


def detect_brand(texts: DataFrame, brands: DataFrame, max_brands: int = MAX_BRANDS_PER_AD) -> DataFrame:
    return attach_brand(texts, brands, max_brands).select("id", "brand")


def detect_model(branded: DataFrame, models: DataFrame, reject_at: int = MODEL_HITS_TO_REJECT) -> DataFrame:
    """(id, brand, model): the longest model found in a text ``(id, brand, text)``, the earliest of
    equally long ones, all of those that also start together. Texts with ``reject_at`` or more models
    give none. One exchange, of the hits on id; a group holds the models found in one text."""
    return longest_models(dictionary_hits(branded, models, ["model", "length"], on=["brand"]), reject_at)


def longest_models(hits: DataFrame, reject_at: int = MODEL_HITS_TO_REJECT) -> DataFrame:
    """``detect_model`` of the hits (id, brand, model, length, tok, off)."""
    of_text = Window.partitionBy("id")
    return (
        hits.repartition("id").groupBy("id", "brand", "model", "length")
        .agg(F.min(F.struct("tok", "off")).alias("place"))
        .withColumn("n", F.count("*").over(of_text))
        .filter(F.col("n") < reject_at)
        .withColumn("rank", F.struct(-F.col("length"), F.col("place")))
        .withColumn("best", F.min("rank").over(of_text))
        .filter(F.col("rank") == F.col("best"))
        .select("id", "brand", "model")
    )


def brand_model(
    texts: DataFrame,
    brands: DataFrame,
    models: DataFrame,
    max_brands: int = MAX_BRANDS_PER_AD,
    reject_at: int = MODEL_HITS_TO_REJECT,
    keep_all: bool = False,
) -> DataFrame:
    """One row (id, further columns of the texts, brand, model) per text that names a brand, or per text
    (``keep_all``); model NULL where none is found. Several models in first place, or several brands
    without any: by brand, then by model name. One exchange, of the hits."""
    carry = [c for c in texts.columns if c not in ("id", "text")]
    branded = attach_brand(texts, brands, max_brands, keep_all)
    hits = dictionary_hits(branded, models, ["model", "length"], on=["brand"], keep_all=True, carry=carry)
    # one number for (tok, off), in their order, so that the hits are combined by hash, not sorted by names
    place = F.shiftleft(F.col("tok").cast("bigint"), 32) + F.col("off")
    found = hits.repartition("id").groupBy("id", "brand", "model", "length").agg(
        F.min(place).alias("place"), *[F.any_value(c).alias(c) for c in carry]
    )
    rank = F.struct(-F.col("length"), F.col("place"), F.col("brand"), F.col("model"))
    best = found.groupBy("id").agg(
        F.count("model").alias("n"),
        F.min("brand").alias("brand"),
        F.min(F.when(F.col("model").isNotNull(), rank)).alias("hit"),
        *[F.any_value(c).alias(c) for c in carry],
    )
    keep = F.col("n").between(1, reject_at - 1)
    return best.select(
        "id",
        *carry,
        F.when(keep, F.col("hit.brand")).otherwise(F.col("brand")).alias("brand"),
        F.when(keep, F.col("hit.model")).alias("model"),
    )


def brand_dimension(listings: DataFrame, brands: DataFrame, models: DataFrame) -> DataFrame:
    return (
        brand_model(listing_texts(listings), brands, models)
        .filter(F.col("brand") != "")
        .withColumn("hash", row_hash("brand", "model"))
    )
