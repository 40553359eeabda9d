"""Text functions, storage, brands and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.checks import views as v
from mercato.checks.registry import query
from mercato.constants import BRAND_ALIASES
from mercato.functions import text as t
from mercato.operators import dictionary, matching, storage
from mercato.operators.dedup import keep_first, with_ties
from mercato.plans import jobs
from mercato.sources.readers import table


@query("fmt_text", f"SELECT doc_id, {v.squeeze_sql('text')} AS text FROM documents")
def fmt_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.squeeze(F.col("text")).alias("text"))


@query("norm_text", f"SELECT doc_id, {v.norm_sql('text')} AS text FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.norm_text(F.col("text")).alias("text"))


@query(
    "norm_text_explore",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(split_part(lower(text), 'tag', 1),
        '\+', ' plus', 'g'), '[^a-z0-9]', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM documents""",
)
def norm_text_explore(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.norm_text_at_tag(F.col("text")).alias("text"))


@query("row_hash", f"SELECT p_partkey, {v.hash_sql('p_name', 'p_brand', 'p_size', 'p_retailprice')} AS hash FROM part")
def row_hash(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", t.row_hash("p_name", "p_brand", "p_size", "p_retailprice").alias("hash"))


@query(
    "daily_name",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type FROM events),
       n AS (SELECT *, CAST(extract(day FROM day) AS INTEGER) % 4 - 1 AS days FROM d)
       SELECT day, event_type, strftime(day, '%d-%m-%Y') ||
         CASE WHEN days < 0 THEN '-all-' WHEN days <= 1 THEN '-daily-' ELSE '-' || days || '-' END
         || event_type || '.json' AS file_name FROM n""",
)
def daily_name(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "event_type").distinct()
    span = F.dayofmonth("day") % 4 - 1
    return days.withColumn("file_name", t.file_name_column(F.col("day"), F.col("event_type"), span))


STORAGE_SQL = f"""sized AS (SELECT id, {v.storage_sql('text')} AS storage_gb FROM texts)"""


@query(
    "storage_extract",
    v.with_(v.TEXTS_SQL, STORAGE_SQL)
    + f"SELECT id, storage_gb, {v.hash_sql('storage_gb')} AS hash FROM sized WHERE storage_gb > 0",
)
def storage_extract(spark, sf_dir):
    return storage.storage_dimension(v.phones(spark, sf_dir))


@query(
    "price_by_storage",
    v.with_(v.TEXTS_SQL, STORAGE_SQL)
    + """SELECT s.storage_gb, count(*) AS n_ads, min(l.price) AS lowest_price, max(l.price) AS highest_price,
           CAST(sum(TRY_CAST(l.price AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_price
         FROM sized s JOIN listing l ON l.id = s.id WHERE s.storage_gb > 0 AND l.price >= 0 GROUP BY s.storage_gb""",
)
def price_by_storage(spark, sf_dir):
    ads = v.phones(spark, sf_dir)
    text = t.listing_text(F.col("info.title"), F.col("info.description"))
    return (
        storage.with_storage(ads.select(text.alias("text"), "cost.price").filter("price >= 0"))
        .groupBy("storage_gb")
        .agg(
            F.count("*").alias("n_ads"),
            F.min("price").alias("lowest_price"),
            F.max("price").alias("highest_price"),
            F.sum(F.col("price").try_cast("decimal(18,2)")).alias("total_price"),
        )
    )


@query(
    "theta_regex_join",
    v.with_(v.TEXTS_SQL, v.BRANDS_SQL, v.BRAND_HITS_SQL) + "SELECT id, brand, CAST(pos AS INTEGER) AS match_pos FROM brand_hits",
)
def theta_regex_join(spark, sf_dir):
    ads, brands = v.texts(spark, sf_dir), v.brands(spark, sf_dir)
    return matching.first_matches(ads, brands, ["brand"])


@query("brand_detect", v.with_(v.TEXTS_SQL, v.BRANDS_SQL, v.BRAND_HITS_SQL) + "SELECT DISTINCT id, brand FROM branded")
def brand_detect(spark, sf_dir):
    return matching.detect_brand(v.texts(spark, sf_dir), v.brands(spark, sf_dir))


@query(
    "multi_brand_rejects",
    v.with_(v.TEXTS_SQL, v.BRANDS_SQL, v.BRAND_HITS_SQL)
    + "SELECT id, count(*) AS n_brands FROM brand_hits GROUP BY id HAVING count(*) > 3",
)
def multi_brand_rejects(spark, sf_dir):
    return matching.multi_brand(v.texts(spark, sf_dir), v.brands(spark, sf_dir))


MODEL_CTES = v.with_(v.TEXTS_SQL, v.BRANDS_SQL, v.MODELS_SQL, v.BRAND_HITS_SQL, v.MODEL_HITS_SQL)


@query("model_detect", MODEL_CTES + "SELECT id, brand, model FROM found")
def model_detect(spark, sf_dir):
    branded = matching.attach_brand(v.texts(spark, sf_dir), v.brands(spark, sf_dir))
    return matching.detect_model(branded, v.models(spark, sf_dir))


@query("brand_model_dim", MODEL_CTES + f"SELECT id, brand, model, {v.hash_sql('brand', 'model')} AS hash FROM brand_model")
def brand_model_dim(spark, sf_dir):
    return matching.brand_dimension(v.phones(spark, sf_dir), v.brands(spark, sf_dir), v.models(spark, sf_dir))


@query(
    "wide_listing",
    MODEL_CTES
    + f"""SELECT t.id, {v.storage_sql('t.text')} AS storage_gb, b.brand, b.model
          FROM texts t LEFT JOIN brand_model b ON b.id = t.id""",
)
def wide_listing(spark, sf_dir):
    return jobs.wide_listing(v.phones(spark, sf_dir), v.brands(spark, sf_dir), v.models(spark, sf_dir))


@query(
    "wide_rows",
    v.with_(v.TEXTS_SQL, v.BRANDS_SQL, v.MODELS_SQL, v.BRAND_HITS_SQL.replace("<= 3", "<= 2"), v.MODEL_HITS_SQL)
    + f"""SELECT l.id, 'Product' AS category, l.title, l.description, l.url, l.currency, l.price, l.date, {v.storage_sql('t.text')} AS storage_gb,
            b.brand, b.model
          FROM listing l JOIN texts t ON t.id = l.id LEFT JOIN brand_model b ON b.id = l.id""",
)
def wide_rows(spark, sf_dir):
    rows = jobs.wide_rows(v.phones(spark, sf_dir), v.brands(spark, sf_dir), v.models(spark, sf_dir))
    return rows.select("id", "category", "info.*", "cost.*", "date", "storage_gb", "brand", "model")


@query(
    "outer_attach",
    v.with_(v.TEXTS_SQL, v.BRANDS_SQL, v.BRAND_HITS_SQL)
    + "SELECT t.id, b.brand FROM texts t LEFT JOIN branded b ON b.id = t.id",
)
def outer_attach(spark, sf_dir):
    ads = v.texts(spark, sf_dir)
    return ads.select("id").join(matching.detect_brand(ads, v.brands(spark, sf_dir)), "id", "left")


@query("dict_brands", v.with_(v.BRANDS_SQL) + "SELECT brand, pattern FROM brands")
def dict_brands(spark, sf_dir):
    return dictionary.clean_brands(v.raw_brands(spark, sf_dir))


@query("dict_catalog", v.with_(v.MODELS_SQL) + "SELECT brand, model, url FROM models")
def dict_catalog(spark, sf_dir):
    doubled = v.raw_models(spark, sf_dir).select("brand", F.concat(F.lit("  "), F.col("model")).alias("model"), "url")
    return dictionary.clean_catalogue(doubled.unionByName(v.raw_models(spark, sf_dir).select("brand", "model", "url")))


@query("dict_models", v.with_(v.MODELS_SQL) + "SELECT brand, model, pattern, length, url FROM models")
def dict_models(spark, sf_dir):
    return dictionary.clean_models(v.raw_models(spark, sf_dir))


@query(
    "dict_alias",
    r"SELECT DISTINCT p_brand AS brand, '\b' || lower(p_brand) || '\b' AS pattern FROM part UNION ALL VALUES "
    + ", ".join(f"('{b}', '{p}')" for b, p in BRAND_ALIASES.items()),
)
def dict_alias(spark, sf_dir):
    plain = dictionary.own_name_patterns(table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand")).distinct())
    return plain.unionByName(spark.createDataFrame(list(BRAND_ALIASES.items()), plain.schema))


@query(
    "union_dicts",
    v.with_(v.BRANDS_SQL, v.MODELS_SQL)
    + "SELECT brand, pattern FROM brands UNION ALL SELECT brand, pattern FROM models",
)
def union_dicts(spark, sf_dir):
    return v.brands(spark, sf_dir).unionByName(v.models(spark, sf_dir).select("brand", "pattern"))


# A catalogue with the names each brand's rules deal with, built from the parts.
_CATALOGUE = """
  CASE p_partkey % 6 WHEN 0 THEN 'Apple' WHEN 1 THEN 'Samsung' WHEN 2 THEN 'Google' WHEN 3 THEN 'Motorola'
    WHEN 4 THEN 'LG' ELSE 'OnePlus' END AS brand,
  CASE p_partkey % 6
    WHEN 0 THEN CASE p_size % 5 WHEN 0 THEN 'iPhone ' || n WHEN 1 THEN 'Apple iPhone ' || n || 'c (2020)'
      WHEN 2 THEN 'iPad ' || p_name WHEN 3 THEN 'iPhone ' || n || ' Plus+  Max' ELSE 'iPhone' END
    WHEN 1 THEN CASE p_size % 5 WHEN 0 THEN 'Galaxy A0' || n || 's' WHEN 1 THEN 'Galaxy S' || n || '+ 5G (2021)'
      WHEN 2 THEN 'Galaxy Tab ' || n WHEN 3 THEN 'Galaxy A' || n || ' ' || p_name ELSE 'galaxy Note' || n || ' 4g' END
    WHEN 2 THEN CASE p_size % 5 WHEN 0 THEN 'Pixel' WHEN 1 THEN 'Pixel ' || n || ' Pro 5G' WHEN 2 THEN 'Pixel C'
      WHEN 3 THEN 'Pixel Watch ' || n ELSE 'Pixel ' || n || 'a' END
    WHEN 3 THEN CASE p_size % 5 WHEN 0 THEN 'Moto G' || n || 's (2nd gen)' WHEN 1 THEN 'Edge 20' || n || ' 5G'
      WHEN 2 THEN 'Moto 360 ' || n WHEN 3 THEN 'DROID ' || p_name || n ELSE 'Charm ' || n END
    WHEN 4 THEN CASE p_size % 5 WHEN 0 THEN 'G' || n || ' ThinQ' WHEN 1 THEN 'Stylo ' || n || ' A'
      WHEN 2 THEN 'K' || n || ' LTE' WHEN 3 THEN 'Velvet 5G (' || p_name || ')' ELSE 'X' || (n + 100) END
    ELSE CASE p_size % 5 WHEN 0 THEN 'Nord CE' || n || ' Lite 5G' WHEN 1 THEN n || 'T McLaren' WHEN 2 THEN 'Pad ' || n
      WHEN 3 THEN 'Ace ' || n || 'v+ 150W' ELSE n || 'r Racing ' || p_name END
  END AS name, '/p/' || p_partkey AS url"""
_PARTS_N = "(SELECT *, p_partkey % 40 + 1 AS n FROM part)"


def catalogue(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("n", F.expr("p_partkey % 40 + 1"))
    raw = spark.sql(f"SELECT {_CATALOGUE} FROM {{part}}", part=part).withColumnRenamed("name", "model")
    return dictionary.clean_catalogue(raw)


def _erase(x, *patterns):
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


def _split(x, p, groups):
    parts = " ".join(rf"\{i}" for i in range(1, groups + 3))
    return rf"regexp_replace({x}, '(?i)^(.*)\b{p}\b(.*)$', '{parts}')"


_SQ = v.squeeze_sql
_RULES_SQL = {
    "Apple": (
        _SQ(_erase("name", r"\(.*\)", "(?i)iphone")),
        "NOT regexp_matches(name, '(?i)(ipad|watch|CDMA)') AND model <> ''",
        _SQ(_split("model", r"(\d+)([cegs]+)", 2)),
    ),
    "Samsung": (
        _SQ("replace(" + _erase("name", r"(?i)(4g|5g|\(.*\))") + ", 'Galaxy', '')"),
        "NOT regexp_matches(name, '(?i)(watch|tab|sgh)') AND "
        + "regexp_matches(" + _erase("name", r"(?i)(4g|5g|\(.*\))") + ", '(?i)galaxy')",
        _SQ(
            r"regexp_replace(regexp_replace("
            + _split("model", r"([a-z]+)(\d+)([a-z]?)", 3)
            + r", '\b0', '0?', 'g'), '\bA\s', 'A', 'g')"
        ),
    ),
    "Google": (
        "CASE WHEN " + _SQ("replace(replace(name, 'Pixel', ''), '5G', '')") + " = '' THEN '1' ELSE "
        + _SQ("replace(replace(name, 'Pixel', ''), '5G', '')") + " END",
        "NOT regexp_matches(name, '(?i)(watch|tablet)') AND model <> 'C'",
        "model",
    ),
    "Motorola": (
        _SQ("replace(" + _erase("name", r"(?i)(4G|5G|\(.*\))", r"20\d{2}") + ", 'Moto', '')"),
        r"regexp_matches(name, '\b(DROID|Edge|Moto|Nexus|One|Razr|ThinkPhone)\b') AND "
        "NOT regexp_matches(name, '(?i)(watch|pad|dual|tab|360|uw|xyboard)')",
        _SQ(_split("model", r"([a-z]*)(\d+)(s?)", 3)),
    ),
    "LG": (
        _SQ(_erase("name", r"(?i)(\(.*\)|5g|thinQ)")),
        r"NOT regexp_matches(name, '(?i)(pad|watch|optimus|uw|dual|lte)') AND NOT regexp_matches(name, '\b\w\d{3,4}\b') "
        r"AND (regexp_matches(" + _erase("name", r"(?i)(\(.*\)|5g|thinQ)") + r", '\b(G|K|Q|V)\d*\b') OR "
        r"regexp_matches(" + _erase("name", r"(?i)(\(.*\)|5g|thinQ)") + r", '(?i)\b(nexus|stylo|stylus|velvet)\b'))",
        _SQ(r"regexp_replace(" + _split("model", r"([a-z]+)(\d+)", 2) + r", '\s+A\b', 'A', 'g')"),
    ),
    "OnePlus": (
        _SQ(_erase("name", r"(?i)(5g|mclaren|racing|150w|\(.*\))")),
        "NOT regexp_matches(name, '(?i)(watch|pad|uw)')",
        _SQ(_split(_split("model", r"(\d+)([a-z\+]+)", 2), r"([a-z]+)(\d+)", 2)),
    ),
}


def _case(i):
    return "CASE brand " + " ".join(f"WHEN '{b}' THEN {r[i]}" for b, r in _RULES_SQL.items()) + " END"


@query(
    "model_patterns",
    f"""WITH r AS (SELECT {_CATALOGUE} FROM {_PARTS_N}),
        c AS (SELECT brand, {_SQ('name')} AS name, min(url) AS url FROM r GROUP BY ALL),
        m AS (SELECT brand, name, url, {_case(0)} AS model FROM c),
        k AS (SELECT * FROM m WHERE {_case(1)}
              QUALIFY row_number() OVER (PARTITION BY brand, model ORDER BY name, url) = 1)
        SELECT brand, model, url, {v.pattern_sql('shape')} AS pattern,
               CAST(length(replace(model, ' ', '')) AS INTEGER) AS length
        FROM (SELECT *, {_case(2)} AS shape FROM k)""",
)
def model_patterns(spark, sf_dir):
    return dictionary.model_dictionary(catalogue(spark, sf_dir))


@query(
    "dedup_first",
    """SELECT doc_id, lang, source, n_chars FROM documents
       QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def dedup_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # the digest stands for the text, so that texts do not travel
    keyed = docs.select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("digest"))
    return keep_first(keyed, ["digest"], ["doc_id"]).drop("digest")


@query(
    "dedup_sorted",
    f"""SELECT p_brand, model, p_name, p_partkey FROM (
          SELECT *, {v.squeeze_sql("replace(p_name, 'widget', '')")} AS model FROM part)
        QUALIFY row_number() OVER (PARTITION BY p_brand, model ORDER BY p_name, p_partkey) = 1""",
)
def dedup_sorted(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_brand", t.squeeze(F.replace("p_name", F.lit("widget"), F.lit(""))).alias("model"), "p_name", "p_partkey"
    )
    return keep_first(part, ["p_brand", "model"], ["p_name", "p_partkey"])


@query(
    "best_with_ties",
    "SELECT p_brand, p_partkey, p_size FROM part QUALIFY p_size = max(p_size) OVER (PARTITION BY p_brand)",
)
def best_with_ties(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size")
    return with_ties(part, ["p_brand"], "p_size", largest=True)
