"""Listings derived from the test tables, in Spark and as SQL common table expressions.

An order is an ad: its first part gives name, brand, type and size, its customer the place. The column
expressions are plain SQL that both engines read; everything the operators do to them is written
separately on the two sides.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.constants import STORAGE_PATTERNS
from mercato.functions.text import compact_length, norm_text, to_pattern
from mercato.operators import conform, dictionary
from mercato.operators.matching import listing_texts
from mercato.sources.readers import table

RUN_DAY = date(2026, 1, 1)
RUN_SQL = "TIMESTAMP '2026-01-01 00:00:00'"

_PARTS_LIST = (
    "red widget, blue bolt, hot gear, small gizmo, old bolt, large plate, blue gear, large anvil, red ring, "
    "old anvil, new bolt, cold rod, hot plate, old gear, new ring, small rod, cold gizmo, red rod, new anvil, "
    "hot ring"
)

TEXT_COLUMNS = {
    "ID": "CASE WHEN k % 97 = 0 THEN 'ad-' || CAST(k AS STRING) ELSE CAST(k AS STRING) END",
    "Category": "'Product'",
    "Title": (
        "CASE WHEN k % 59 = 0 THEN '  ' WHEN k % 13 = 0 THEN ' ' || p_brand || '   ' || p_name || ' + Case ' "
        "ELSE p_name || ' ' || p_brand END"
    ),
    "Description": (
        f"CASE WHEN k % 29 = 0 THEN 'Parts for {_PARTS_LIST}' "
        "WHEN k % 6 = 0 THEN p_type || ' ' || CAST(p_size AS STRING) || ' GB' "
        "WHEN k % 6 = 1 THEN p_type || ', ' || CAST(p_size AS STRING) || 'Go' "
        "WHEN k % 6 = 2 THEN CAST(p_size AS STRING) || 'g  ' || p_type "
        "WHEN k % 6 = 3 THEN '1TB ' || p_type || ' ' || CAST(p_size % 9 + 1 AS STRING) || ' gb RAM' "
        "WHEN k % 6 = 4 THEN p_type || ' 128gb/' || CAST(p_size AS STRING) || 'gb Tags: ' || p_brand || ' vintage' "
        "WHEN k % 12 = 5 THEN 'swap for Brand#' || CAST(p_size % 25 + 1 AS STRING) || ' or Brand#' || "
        "CAST((p_size + 7) % 25 + 1 AS STRING) || ' or Brand#' || CAST((p_size + 11) % 25 + 1 AS STRING) "
        "ELSE NULL END"
    ),
    "url": "'https://market.example/ad/' || CAST(k AS STRING)",
}
COST_COLUMNS = {
    "Price": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 11 = 1 THEN -total ELSE total - 10 * r END",
    "Currency": "CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN 'US' WHEN 2 THEN 'USD' ELSE 'CAD' END",
    "Date": "CASE WHEN k % 101 = 0 AND r = 0 THEN 'n/a' ELSE CAST(day + 7 * r AS STRING) END",
}
_HALF1 = "substr('ABCEGHJKLM', CAST(ck % 10 + 1 AS INT), 1) || CAST(ck % 7 AS STRING) || substr('STVXYNPRWZ', CAST(ck % 10 + 1 AS INT), 1)"
_HALF2 = "CAST(ck % 9 AS STRING) || substr('ABCEGHJKLM', CAST((ck + 3) % 10 + 1 AS INT), 1) || CAST(ck % 8 AS STRING)"
PLACE_COLUMNS = {
    "Address": (
        "CASE k % 6 WHEN 0 THEN c_name || ', ' || n_name || ',' "
        f"WHEN 1 THEN c_name || ', ' || n_name || ', ' || {_HALF1} || ' ' || {_HALF2} "
        f"WHEN 2 THEN c_name || ', ' || n_name || ', ' || {_HALF1} || {_HALF2} "
        f"WHEN 3 THEN lower({_HALF1}) || '  ' || c_name "
        f"WHEN 4 THEN {_HALF1} || ' ' || {_HALF2} "
        f"ELSE {_HALF1} || {_HALF2} || ' ' || n_name || ', ' || {_HALF1} || {_HALF2} END"
    ),
    "City": "n_name",
    "Country": "CASE WHEN k % 53 = 0 THEN '' ELSE r_name END",
    "Latitude": "CAST(ck % 200 AS DOUBLE) - 99.75",
    "Longitude": "CAST(ck * 7 % 400 AS DOUBLE) - 199.5",
}
VEHICLE_COLUMNS = {
    "Brand": "CASE WHEN k % 31 = 0 THEN NULL ELSE p_brand END",
    "Model": "p_name",
    "Year": "CASE WHEN k % 37 = 0 THEN 'n/a' ELSE CAST(1895 + k % 140 AS STRING) END",
    "Odometer": "CASE WHEN k % 41 = 0 THEN 'low' ELSE CAST(CAST(floor(total) AS BIGINT) AS STRING) END",
    "OdometerUnits": "CASE k % 5 WHEN 0 THEN 'KMT' WHEN 1 THEN 'mi' WHEN 2 THEN 'KM' WHEN 3 THEN 'yd' END",
}


def run_stamp(day: str = "2026-01-01") -> Column:
    """Midnight in the session's time zone, whichever that is."""
    return F.lit(day).cast("timestamp")


def ads(spark: SparkSession, sf_dir: str, place: bool = False, shuffled: bool = False) -> DataFrame:
    """One row per ad and posting; every tenth ad is posted twice. ``shuffled``: parts and customers are not broadcast at any size."""

    def joined(df: DataFrame) -> DataFrame:
        return df.hint("merge") if shuffled else df

    first_part = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("p_partkey"))
    )
    df = (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("ck"),
            F.col("o_totalprice").alias("total"),
            F.col("o_orderdate").cast("date").alias("day"),
        )
        # both sides grow with the data: never a broadcast, however small a test table is
        .join(first_part.hint("merge"), F.col("k") == F.col("l_orderkey"))
        .join(joined(table(spark, sf_dir, "part").drop("p_retailprice")), "p_partkey")
    )
    if place:
        homes = (
            table(spark, sf_dir, "customer")
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "c_name", "n_name", "r_name")
        )
        df = df.join(joined(homes), F.col("ck") == F.col("c_custkey"))
    postings = F.when(F.col("k") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("r", F.explode(postings))


def _columns(place: bool, vehicle: bool) -> dict[str, str]:
    cols = {**TEXT_COLUMNS, **COST_COLUMNS}
    if place:
        cols |= PLACE_COLUMNS
    else:
        cols |= {c: f"CAST(NULL AS {'DOUBLE' if c in ('Latitude', 'Longitude') else 'STRING'})" for c in PLACE_COLUMNS}
    return cols | (VEHICLE_COLUMNS if vehicle else {})


def raw_listings(
    spark: SparkSession, sf_dir: str, place: bool = False, vehicle: bool = False, posting: int | None = None, of: DataFrame | None = None
) -> DataFrame:
    """Flat records as a scraper would land them. Without ``place`` the address columns are NULL and
    the customers are not read. ``posting`` 0 gives the first postings only, 1 the second ones. ``of``: the ads, where they are stored."""
    cols = _columns(place, vehicle)
    rows = ads(spark, sf_dir, place) if of is None else of
    if posting is not None:
        rows = rows.filter(F.col("r") == posting)
    return rows.selectExpr(*[f"{e} AS `{c}`" for c, e in cols.items()])


def phones(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    return conform.conform_phone(raw_listings(spark, sf_dir, place), run_stamp())


def motorcycles(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    return conform.conform_motorcycle(raw_listings(spark, sf_dir, place, vehicle=True), run_stamp())


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_texts(phones(spark, sf_dir))


def raw_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_brand").distinct()
    return part.select(F.col("p_brand").alias("brand"), to_pattern(norm_text(F.col("p_brand"))).alias("pattern"))


def raw_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_brand", "p_name").distinct()
    return part.select(
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("model"),
        F.concat(F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-"))).alias("url"),
        to_pattern(norm_text(F.col("p_name"))).alias("pattern"),
        compact_length(F.col("p_name")).cast("string").alias("length"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned dictionary as the table the matching reads."""
    return dictionary.clean_brands(raw_brands(spark, sf_dir))


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.clean_models(raw_models(spark, sf_dir))


# -- the same in DuckDB SQL


def squeeze_sql(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def norm_sql(x: str) -> str:
    words = rf"regexp_replace(regexp_replace(lower({x}), '\+', ' plus ', 'g'), '[^a-z0-9]+', ' ', 'g')"
    return squeeze_sql(rf"regexp_replace({words}, '\btags.*$', '', 'g')")


def pattern_sql(x: str) -> str:
    return rf"'\b' || regexp_replace(trim(lower(replace({x}, '+', ' plus'))), '\s+', '\\s*', 'g') || '\b'"


def hash_sql(*cols: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in cols) + "))"


# The storage patterns without look-ahead, which RE2 lacks; equal on every input.
_NO_LOOKAHEAD = {
    r"(?!0{3})(\d{3})": r"([1-9]\d\d|0[1-9]\d|00[1-9])",
    r"(?!0{2})(32|64)": "(32|64)",
    r"(?!0{4})(\d{4})": r"([1-9]\d{3}|0[1-9]\d{2}|00[1-9]\d|000[1-9])",
    r"(?!0{3,4})(\d{3,4})": r"([1-9]\d{2,3}|0[1-9]\d{1,2}|00[1-9]\d?)",
    r"(?!0{3,4})(128": "(128",
    r"(?!0{2})(\d{2})": r"([1-9]\d|0[1-9])",
    r"(?!0{2,4})(\d{2,4})": r"([1-9]\d{1,3}|0[1-9]\d{0,2})",
}


def storage_sql(text: str) -> str:
    tries = []
    for unit, pattern in STORAGE_PATTERNS:
        for look, plain in _NO_LOOKAHEAD.items():
            pattern = pattern.replace(look, plain)
        amount = f"CAST(nullif(regexp_extract({text}, '{pattern}', 1), '') AS INTEGER)"
        tries.append(f"{amount} * 1024" if unit == "TB" else amount)
    return "coalesce(" + ", ".join(tries) + ")"


ADS_SQL = """
first_part AS (SELECT l_orderkey, min(l_partkey) AS partkey FROM lineitem GROUP BY l_orderkey),
ad AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_totalprice AS total, CAST(o_orderdate AS DATE) AS day,
         p_name, p_brand, p_type, p_size, c_name, n_name, r_name,
         unnest(CASE WHEN o_orderkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS r
  FROM orders
  JOIN first_part ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = partkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""
RAW_SQL = (
    ADS_SQL
    + ",\nraw AS (SELECT "
    + ", ".join(f'{e} AS "{c}"' for c, e in _columns(place=True, vehicle=True).items() if c not in ("Brand", "Model"))
    + f', {VEHICLE_COLUMNS["Brand"]} AS raw_brand, {VEHICLE_COLUMNS["Model"]} AS raw_model, r AS posting FROM ad)'
)
LISTINGS_SQL = (
    RAW_SQL
    + f""",
listing AS (
  SELECT TRY_CAST(ID AS BIGINT) AS id, Title AS title, Description AS description, url,
         Country AS country, City AS city, Address AS address, Latitude AS lat, Longitude AS lon,
         Currency AS currency, Price AS price, TRY_CAST("Date" AS DATE) AS date, {RUN_SQL} AS processed_at,
         raw_brand, raw_model, TRY_CAST(Year AS INTEGER) AS year,
         replace(OdometerUnits, 'KMT', 'KM') AS unit, TRY_CAST(Odometer AS BIGINT) AS value
  FROM raw WHERE TRY_CAST(ID AS BIGINT) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(ID AS BIGINT) ORDER BY TRY_CAST("Date" AS DATE) DESC NULLS LAST) = 1)"""
)
TEXTS_SQL = (
    LISTINGS_SQL
    + f""",
texts AS (SELECT id, concat_ws(' ', {norm_sql('title')}, {norm_sql('description')}) AS text FROM listing)"""
)
BRANDS_SQL = f"""
brands AS (SELECT DISTINCT p_brand AS brand, {pattern_sql(norm_sql('p_brand'))} AS pattern FROM part)"""
MODELS_SQL = f"""
models AS (
  SELECT DISTINCT p_brand AS brand, p_name AS model, {pattern_sql(norm_sql('p_name'))} AS pattern,
         CAST(length(replace(p_name, ' ', '')) AS INTEGER) AS length, '/' || replace(p_name, ' ', '-') AS url
  FROM part)"""
BRAND_HITS_SQL = """
brand_hits AS (
  SELECT id, text, brand, length(regexp_extract(text, '^(.*?)' || pattern, 1)) + 1 AS pos
  FROM texts JOIN brands ON regexp_matches(text, pattern)),
branded AS (
  SELECT id, text, brand FROM brand_hits
  QUALIFY count(*) OVER (PARTITION BY id) <= 3 AND pos = min(pos) OVER (PARTITION BY id))"""
MODEL_HITS_SQL = """
model_hits AS (
  SELECT b.id, b.brand, m.model, m.length, length(regexp_extract(b.text, '^(.*?)' || m.pattern, 1)) + 1 AS pos
  FROM branded b JOIN models m ON m.brand = b.brand
   AND contains(replace(b.text, ' ', ''), replace(m.model, ' ', '')) AND regexp_matches(b.text, m.pattern)),
few AS (SELECT * FROM model_hits QUALIFY count(*) OVER (PARTITION BY id) < 10),
longest AS (SELECT * FROM few QUALIFY length = max(length) OVER (PARTITION BY id)),
found AS (SELECT DISTINCT id, brand, model FROM (SELECT * FROM longest QUALIFY pos = min(pos) OVER (PARTITION BY id))),
brand_model AS (
  SELECT b.id, b.brand, f.model FROM branded b LEFT JOIN found f ON f.id = b.id AND f.brand = b.brand
  QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY f.model IS NULL, b.brand, f.model) = 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
