"""Large dictionaries, regexes that are no plain words, names that are nearly there, and changes in a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mercato.checks import views as v
from mercato.checks.registry import query
from mercato.functions.text import compact_length, norm_text, to_pattern
from mercato.operators import fuzzy, matching, quality
from mercato.session import staging_dir
from mercato.sources.readers import table
from mercato.sources.tables import stage
from mercato.streaming.changes import CHANGES, changes

#: One regex per distinct part: the beginning of its first word, any end, its second word, and its size behind it.
_REGEX = (
    "'\\\\b' || substr(p_name, 1, 3) || '[a-z]*\\\\s+' || substr(p_name, instr(p_name, ' ') + 1) || "
    "'\\\\b(?:.*)\\\\b' || CAST(p_size AS STRING) || '\\\\s*(?:gb|go?)\\\\b'"
)
_REGEX_SQL = _REGEX.replace("\\\\", "\\")


@query(
    "theta_regex_join_regexes",
    v.with_(
        v.TEXTS_SQL,
        f"""rules AS (SELECT DISTINCT p_name || ' ' || p_size AS rule, {_REGEX_SQL} AS pattern,
              substr(p_name, instr(p_name, ' ') + 1) AS word, CAST(p_size AS VARCHAR) AS size FROM part)""",
    )
    + """SELECT id, rule, CAST(length(regexp_extract(text, '^(.*?)' || pattern, 1)) + 1 AS INTEGER) AS match_pos
         FROM texts JOIN rules ON contains(text, word) AND contains(text, size) AND regexp_matches(text, pattern)""",
)
def theta_regex_join_regexes(spark, sf_dir):
    """Some two thousand regexes that no word lookup can find."""
    rules = table(spark, sf_dir, "part").select(F.expr("p_name || ' ' || p_size").alias("rule"), F.expr(_REGEX).alias("pattern")).distinct()
    hits = matching.first_matches(v.texts(spark, sf_dir), stage(rules, "rules"), ["rule"])
    return hits.select("id", "rule", F.col("match_pos").cast("int").alias("match_pos"))


#: Brands of which there are more than a row can try: a brand and a size.
_MANY = "SELECT DISTINCT p_brand || ' ' || p_name AS brand, {pattern} AS pattern FROM part UNION ALL SELECT DISTINCT p_brand, {brand} FROM part"
_MANY_SQL = "brands AS (" + _MANY.format(pattern=v.pattern_sql(v.norm_sql("p_name")), brand=v.pattern_sql(v.norm_sql("p_brand"))) + ")"


def _many_brands(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select(F.concat_ws(" ", "p_brand", "p_name").alias("brand"), to_pattern(norm_text(F.col("p_name"))).alias("pattern"))
    own = part.select(F.col("p_brand").alias("brand"), to_pattern(norm_text(F.col("p_brand"))).alias("pattern"))
    return stage(names.distinct().unionByName(own.distinct()), "many-brands")


_MANY_HITS = """hits AS (
  SELECT id, brand, length(regexp_extract(text, '^(.*?)' || pattern, 1)) + 1 AS pos
  FROM texts JOIN brands ON contains(replace(text, ' ', ''), replace(replace(pattern, '\\s*', ''), '\\b', '')) AND regexp_matches(text, pattern))"""


@query(
    "brand_detect_many",
    v.with_(v.TEXTS_SQL, _MANY_SQL, _MANY_HITS)
    + """SELECT DISTINCT id, brand FROM (SELECT * FROM hits QUALIFY count(*) OVER (PARTITION BY id) <= 30
         AND pos = min(pos) OVER (PARTITION BY id))""",
)
def brand_detect_many(spark, sf_dir):
    """More entries than are tried in the row: the lookup by words."""
    return matching.detect_brand(v.texts(spark, sf_dir), _many_brands(spark, sf_dir), max_brands=30)


@query(
    "multi_brand_many",
    v.with_(v.TEXTS_SQL, _MANY_SQL, _MANY_HITS) + "SELECT id, count(*) AS n_brands FROM hits GROUP BY id HAVING count(*) > 30",
)
def multi_brand_many(spark, sf_dir):
    return matching.multi_brand(v.texts(spark, sf_dir), _many_brands(spark, sf_dir), max_brands=30)


# -- nearly

#: Two of three texts lose a letter: of their beginning, where the name stands, or anywhere.
_TYPO = """CASE id % 3 WHEN 0 THEN text
  WHEN 1 THEN substr(text, 1, CAST(id % 17 AS INT)) || substr(text, CAST(id % 17 AS INT) + 2)
  ELSE substr(text, 1, CAST(id % length(text) AS INT)) || substr(text, CAST(id % length(text) AS INT) + 2) END"""
#: The name stands for a brand, name and brand for a model.
_FUZZY_SQL = f"""
typed AS (SELECT id, CASE WHEN length(text) > 20 THEN {_TYPO} ELSE text END AS text FROM texts),
brands AS (SELECT DISTINCT p_name AS brand, {v.pattern_sql(v.norm_sql('p_name'))} AS pattern, {v.norm_sql('p_name')} AS name FROM part),
models AS (
  SELECT DISTINCT p_name AS brand, p_name || ' ' || p_brand AS model, {v.pattern_sql(v.norm_sql("p_name || ' ' || p_brand"))} AS pattern,
    length(replace(p_name || ' ' || p_brand, ' ', '')) AS length, {v.norm_sql("p_name || ' ' || p_brand")} AS name FROM part),
brand_hits AS (
  SELECT id, text, brand, length(regexp_extract(text, '^(.*?)' || pattern, 1)) + 1 AS pos FROM typed JOIN brands ON regexp_matches(text, pattern)),
many AS (SELECT id FROM brand_hits GROUP BY id HAVING count(*) > 3),
exact AS (
  SELECT DISTINCT id, text, brand FROM (SELECT * FROM brand_hits QUALIFY count(*) OVER (PARTITION BY id) <= 3 AND pos = min(pos) OVER (PARTITION BY id))),
w AS (SELECT id, text, string_split(text, ' ') AS words FROM typed),
runs AS MATERIALIZED (
  SELECT DISTINCT id, array_to_string(words[p:p + k - 1], ' ') AS run
  FROM (SELECT id, words, unnest(range(1, len(words) + 1)) AS p FROM w), (SELECT unnest(range(1, 8)) AS k) WHERE p + k - 1 <= len(words)),
brand_near AS (
  SELECT id, brand, 1 - levenshtein(run, name)::DOUBLE / greatest(length(run), length(name)) AS similarity
  FROM (SELECT * FROM runs WHERE id NOT IN (SELECT id FROM brand_hits)) JOIN brands ON abs(length(run) - length(name)) <= 3
  WHERE 10 * levenshtein(run, name) <= greatest(length(run), length(name))),
near AS (SELECT id, brand, similarity FROM brand_near QUALIFY row_number() OVER (PARTITION BY id ORDER BY similarity DESC, brand) = 1),
branded AS MATERIALIZED (
  SELECT id, text, brand, 1.0::DOUBLE AS brand_similarity FROM exact UNION ALL SELECT id, text, brand, similarity FROM near JOIN typed USING (id)),
model_hits AS MATERIALIZED (
  SELECT b.id, b.brand, m.model, m.length, length(regexp_extract(b.text, '^(.*?)' || m.pattern, 1)) + 1 AS pos
  FROM branded b JOIN models m ON m.brand = b.brand AND regexp_matches(b.text, m.pattern)),
few AS (SELECT * FROM model_hits QUALIFY count(*) OVER (PARTITION BY id) < 10),
longest AS (SELECT * FROM few QUALIFY length = max(length) OVER (PARTITION BY id)),
by_pattern AS (SELECT DISTINCT id, brand, model FROM (SELECT * FROM longest QUALIFY pos = min(pos) OVER (PARTITION BY id))),
model_near AS (
  SELECT b.id, b.brand, m.model, 1 - levenshtein(run, name)::DOUBLE / greatest(length(run), length(name)) AS similarity
  FROM (SELECT * FROM branded WHERE id NOT IN (SELECT id FROM model_hits)) b JOIN models m ON m.brand = b.brand JOIN runs r ON r.id = b.id
  WHERE abs(length(run) - length(name)) <= 4 AND 10 * levenshtein(run, name) <= greatest(length(run), length(name))),
by_name AS (SELECT id, brand, model, similarity FROM model_near QUALIFY row_number() OVER (PARTITION BY id, brand ORDER BY similarity DESC, model) = 1),
found AS (
  SELECT b.id, b.brand, b.brand_similarity, m.model, m.similarity AS model_similarity FROM branded b
  LEFT JOIN (SELECT id, brand, model, 1.0::DOUBLE AS similarity FROM by_pattern UNION ALL SELECT * FROM by_name) m ON m.id = b.id AND m.brand = b.brand
  QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY m.model IS NULL, m.similarity DESC, b.brand_similarity DESC, b.brand, m.model) = 1)"""


@query(
    "fuzzy_brand_model",
    v.with_(v.TEXTS_SQL, _FUZZY_SQL)
    + """SELECT t.id, CASE WHEN t.id IN (SELECT id FROM many) THEN NULL ELSE coalesce(f.brand, 'Other') END AS brand,
           CASE WHEN t.id IN (SELECT id FROM many) THEN NULL ELSE coalesce(f.model, 'Other') END AS model, brand_similarity, model_similarity
         FROM typed t LEFT JOIN found f ON f.id = t.id""",
)
def fuzzy_brand_model(spark, sf_dir):
    """Texts with typing errors: patterns first, then names at 90 %, against all pairs of runs and names."""
    texts = v.texts(spark, sf_dir).withColumn("text", F.expr(f"CASE WHEN length(text) > 20 THEN {_TYPO} ELSE text END"))
    part = table(spark, sf_dir, "part")
    both = F.concat_ws(" ", "p_name", "p_brand")
    brands = part.select(F.col("p_name").alias("brand"), to_pattern(norm_text(F.col("p_name"))).alias("pattern")).distinct()
    models = part.select(
        F.col("p_name").alias("brand"), both.alias("model"), to_pattern(norm_text(both)).alias("pattern"), compact_length(both).alias("length")
    ).distinct()
    return fuzzy.brand_model(texts, stage(brands, "names"), stage(models, "names"))


# -- changes


@query(
    "changed_pages",
    """WITH drops AS (SELECT page_id, url, html, unnest([1, 2, 3]) AS seen FROM pages),
       told AS (SELECT page_id AS id, seen, url || CASE WHEN page_id % 5 = 0 AND seen = 2 THEN ' moved' WHEN page_id % 7 = seen THEN ' edited' ELSE '' END AS url
                FROM drops WHERE NOT (page_id % 11 = 3 AND seen = 2)),
       c AS (SELECT *, lag(url) OVER (PARTITION BY id ORDER BY seen) AS before FROM told)
       SELECT id, seen, before IS NULL AS first FROM c WHERE url IS DISTINCT FROM before""",
)
def changed_pages(spark, sf_dir):
    """Three drops of the pages through a stream: some pages move and move back, some are edited once, some are missing from a drop."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = f"{staging_dir(spark)}/changes-{uuid.uuid4().hex}"
    schema = "page_id bigint, seen bigint, url string, html string"
    for seen in (1, 2, 3):
        edited = F.expr(f"url || CASE WHEN page_id % 5 = 0 AND {seen} = 2 THEN ' moved' WHEN page_id % 7 = {seen} THEN ' edited' ELSE '' END")
        drop = pages.withColumn("url", edited).withColumn("seen", F.lit(seen).cast("bigint")).filter(f"NOT (page_id % 11 = 3 AND {seen} = 2)")
        drop.select("page_id", "seen", "url", "html").write.mode("append").parquet(f"{root}/drops")
        told = changes(spark.readStream.schema(schema).parquet(f"{root}/drops"), "page_id", "seen", ["url", "html"])
        stream = told.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").option("path", f"{root}/out")
        stream.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(CHANGES).parquet(f"{root}/out").select("id", "seen", F.col("before").isNull().alias("first"))


# -- sketches

_MEASURED = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_orderkey": "l_orderkey"}


@query(
    "profile_quantiles",
    """SELECT column_name, q AS quantile, true AS rank_within, true AS distinct_within
       FROM (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_orderkey']) AS column_name), (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS q)""",
)
def profile_quantiles(spark, sf_dir):
    """Quartiles and distinct counts of sketches, each held against a count over all rows: is the rank of the value, and the number of
    distinct values, as near as promised?"""
    lines = table(spark, sf_dir, "lineitem").select(*_MEASURED)
    sketched = stage(quality.quantiles(lines, list(_MEASURED)), "quantiles")
    long = lines.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in _MEASURED])).alias("y")).select("y.*")
    ranks = long.join(F.broadcast(sketched), "column_name").groupBy("column_name", "quantile").agg(  # nine rows
        F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto"),
        F.count(F.lit(1)).alias("n"), F.countDistinct("x").alias("distinct"), F.first("n_distinct").alias("n_distinct"),
    )
    slack = F.col("n") * quality.RANK_ERROR + 1
    rank = (F.col("below") <= F.col("quantile") * F.col("n") + slack) & (F.col("upto") >= F.col("quantile") * F.col("n") - slack)
    near = F.abs(F.col("n_distinct") - F.col("distinct")) <= 0.05 * F.col("distinct") + 1
    return ranks.select("column_name", "quantile", rank.alias("rank_within"), near.alias("distinct_within"))
