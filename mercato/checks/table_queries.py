"""Conforming, dimensions, merges, history, quality and the relational basics."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from mercato.checks import views as v
from mercato.checks.registry import query
from mercato.constants import MODELS_PER_CATALOGUE_PAGE
from mercato.functions.text import row_hash
from mercato.operators import conform, dimensions, merge, pages, quality
from mercato.sources.readers import table
from mercato.sources.tables import stage

L = v.with_(v.LISTINGS_SQL)


@query(
    "conform_listing",
    L + """SELECT id, 'Product' AS category, title, description, url, country, city, address, lat, lon, currency,
           price, date, processed_at FROM listing""",
)
def conform_listing(spark, sf_dir):
    return v.phones(spark, sf_dir, place=True).select(
        "id", "category", "info.*", "location.country", "location.city", "location.address",
        "location.coordinate.*", "cost.*", "date", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
    )


@query(
    "conform_vehicle",
    L + """SELECT id, 'Motorcycle' AS category, title, currency, price, raw_brand AS brand, raw_model AS name, year,
           unit, value, date FROM listing""",
)
def conform_vehicle(spark, sf_dir):
    return v.motorcycles(spark, sf_dir).select(
        "id", "category", "info.title", "cost.currency", "cost.price", "model.*", "odometer.*", "date"
    )


@query(
    "split_listing",
    L + "SELECT id, 'Product' AS category, date AS posted_at, processed_at FROM listing WHERE date IS NOT NULL",
)
def split_listing(spark, sf_dir):
    _, listing = conform.split_listings(v.phones(spark, sf_dir))
    return listing.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


@query(
    "dim_info",
    L + f"""SELECT id, title, description, {v.hash_sql('title', 'description')} AS hash FROM (
           SELECT id, nullif({v.squeeze_sql('title')}, '') AS title,
                  nullif({v.squeeze_sql('description')}, '') AS description FROM listing) WHERE title IS NOT NULL""",
)
def dim_info(spark, sf_dir):
    return dimensions.info(v.phones(spark, sf_dir))


@query(
    "dim_location",
    L + rf""", f AS (SELECT *, regexp_extract(address, '(?i)\b(([A-Z][0-9][A-Z])\s?([0-9][A-Z][0-9])?)\b', 1) AS pc
             FROM listing),
        g AS (SELECT id, country, city, lat, lon,
               regexp_replace({v.squeeze_sql("CASE WHEN pc = '' THEN address ELSE replace(address, pc, '') END")}, ',$', '')
                 AS address,
               nullif({v.squeeze_sql("upper(substr(pc, 1, 3) || ' ' || substr(pc, 4))")}, '') AS postal_code FROM f),
        h AS (SELECT id, country, city, CASE WHEN address = '' THEN postal_code ELSE address END AS address,
               postal_code, lat, lon FROM g)
        SELECT *, {v.hash_sql('country', 'city', 'address', 'postal_code', 'lat', 'lon')} AS hash FROM h
        WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND country <> '' AND city <> '' AND address <> ''""",
)
def dim_location(spark, sf_dir):
    return dimensions.location(v.phones(spark, sf_dir, place=True))


COST_SQL = """cost AS (SELECT id, coalesce(currency, 'CAD') AS currency,
  coalesce(TRY_CAST(price AS DECIMAL(18,2)), 0) AS price FROM listing)"""


@query(
    "dim_cost",
    v.with_(v.LISTINGS_SQL, COST_SQL)
    + f"""SELECT id, currency, CAST(price AS DECIMAL(18,2)) AS price,
            {v.hash_sql('currency', 'CAST(price AS DECIMAL(18,2))')} AS hash
          FROM cost WHERE length(currency) = 3 AND price >= 0""",
)
def dim_cost(spark, sf_dir):
    return dimensions.cost(v.phones(spark, sf_dir))


@query(
    "dim_vehicle",
    L + f"""SELECT id, raw_brand AS brand, raw_model AS model, year, {v.hash_sql('raw_brand', 'raw_model', 'year')} AS hash
           FROM listing WHERE year BETWEEN 1900 AND 2027 AND raw_brand IS NOT NULL AND raw_model IS NOT NULL""",
)
def dim_vehicle(spark, sf_dir):
    return dimensions.vehicle_spec(v.motorcycles(spark, sf_dir), v.RUN_DAY)


@query(
    "dim_odometer",
    L + f"""SELECT id, units, odometer, {v.hash_sql('units', 'odometer')} AS hash FROM (
           SELECT id, lower(unit) AS units, TRY_CAST(value AS INTEGER) AS odometer FROM listing)
           WHERE units IN ('km', 'mi') AND odometer >= 0""",
)
def dim_odometer(spark, sf_dir):
    return dimensions.odometer(v.motorcycles(spark, sf_dir))


# -- merges

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "upsert_orders",
    """WITH shifted AS (SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders) AS o_orderkey, o_custkey, 'N' AS
         o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'),
       batch AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
         o_orderpriority FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM shifted)
       SELECT * FROM batch UNION ALL
       SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)""",
)
def upsert_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    above = orders.agg(F.max("o_orderkey") + 1).scalar()
    changed = orders.filter("o_orderstatus = 'F'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    added = orders.filter("o_orderpriority = '1-URGENT'").withColumns(
        {"o_orderkey": F.col("o_orderkey") + above, "o_orderstatus": F.lit("N")}
    )
    return merge.upsert(orders, changed.unionByName(added), ["o_orderkey"])


def customer_states(orders, *batch):
    """The last order of each customer (and batch), with the row hash of what a change is judged by.
    Rows of a customer combine before the exchange."""
    last = F.max_by(F.struct("o_orderpriority", "o_totalprice"), F.struct("o_orderdate", "o_orderkey"))
    return (
        orders.groupBy("o_custkey", *batch)
        .agg(last.alias("s"))
        .select(
            F.col("o_custkey").alias("id"),
            *batch,
            F.col("s.o_orderpriority").alias("priority"),
            F.col("s.o_totalprice").cast("decimal(18,2)").alias("price"),
        )
        .withColumn("hash", row_hash("priority", "price"))
    )


STATE_SQL = f"""id, priority, price, {v.hash_sql('priority', 'price')} AS hash"""


def _state_sql(where):
    return f"""(SELECT {STATE_SQL} FROM (SELECT o_custkey AS id, o_orderpriority AS priority,
      CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1))"""


SCD2_SQL = f"""
t1 AS (SELECT TIMESTAMP '1999-01-01 00:00:00' AS t), t2 AS (SELECT TIMESTAMP '2002-01-01 00:00:00' AS t),
b1 AS {_state_sql("o_orderdate < TIMESTAMP '1999-01-01 00:00:00'")},
b2 AS {_state_sql("o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'")},
versions AS (
  SELECT b1.*, (SELECT t FROM t1) AS valid_from,
         CASE WHEN b2.hash <> b1.hash THEN (SELECT t FROM t2) END AS valid_to
  FROM b1 LEFT JOIN b2 ON b2.id = b1.id
  UNION ALL
  SELECT b2.*, (SELECT t FROM t2), CAST(NULL AS TIMESTAMP) FROM b2 LEFT JOIN b1 ON b1.id = b2.id
  WHERE b1.id IS NULL OR b1.hash <> b2.hash)"""


def two_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cut = F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz")
    first = stage(customer_states(orders.filter(F.col("o_orderdate") < cut)), "states-1")
    second = stage(customer_states(orders.filter(F.col("o_orderdate") >= cut)), "states-2")
    stamp = F.lit("1999-01-01").cast("timestamp")
    table_1 = first.select("*", stamp.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return merge.scd2_apply(table_1, second, F.lit("2002-01-01"))


def _ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


@query("scd2_apply", v.with_(SCD2_SQL) + "SELECT * FROM versions")
def scd2_apply(spark, sf_dir):
    return _ntz(two_batches(spark, sf_dir))


@query("scd2_current", v.with_(SCD2_SQL) + "SELECT id, priority, price, hash, valid_from FROM versions WHERE valid_to IS NULL")
def scd2_current(spark, sf_dir):
    return _ntz(two_batches(spark, sf_dir)).filter("valid_to IS NULL").drop("valid_to")


@query(
    "scd2_history",
    f"""WITH s AS (SELECT {STATE_SQL}, batch FROM (
          SELECT o_custkey AS id, o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                 CAST(date_trunc('month', o_orderdate) AS DATE) AS batch FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)),
        c AS (SELECT * FROM s QUALIFY hash IS DISTINCT FROM lag(hash) OVER (PARTITION BY id ORDER BY batch))
        SELECT id, priority, price, hash, batch AS valid_from,
               lead(batch) OVER (PARTITION BY id ORDER BY batch) AS valid_to FROM c""",
)
def scd2_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("batch", F.trunc("o_orderdate", "month"))
    return merge.scd2_history(customer_states(orders, "batch"), "id", "batch")


@query(
    "latest_batch",
    """SELECT event_id, user_id, event_type, value FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def latest_batch(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return merge.latest_batch(days, "day").select("event_id", "user_id", "event_type", "value")


# -- the daily jobs over two batches: first postings, then second postings


def _gold_sql(dimension, columns, condition=""):
    """Two batches of a dimension: what both conform to, then the versions that the second leaves."""
    hashed = v.hash_sql(*[c.split(" AS ")[-1] for c in columns])
    names = ", ".join(c.split(" AS ")[-1] for c in columns)
    select = ", ".join(columns)

    def batch(posting):
        return f"""(SELECT id, {names}, {hashed} AS hash FROM (SELECT TRY_CAST(ID AS BIGINT) AS id, {select} FROM raw
          WHERE posting = {posting} AND TRY_CAST(ID AS BIGINT) IS NOT NULL AND TRY_CAST("Date" AS DATE) IS NOT NULL)
          WHERE {condition})"""

    return v.with_(
        v.RAW_SQL,
        f"b1 AS {batch(0)}",
        f"b2 AS {batch(1)}",
    ) + f"""SELECT b1.*, TIMESTAMP '2026-01-01' AS valid_from,
              CASE WHEN b2.hash <> b1.hash THEN TIMESTAMP '2026-01-08' END AS valid_to
            FROM b1 LEFT JOIN b2 ON b2.id = b1.id
            UNION ALL SELECT b2.*, TIMESTAMP '2026-01-08', CAST(NULL AS TIMESTAMP)
            FROM b2 LEFT JOIN b1 ON b1.id = b2.id WHERE b1.id IS NULL OR b1.hash <> b2.hash"""


def _two_runs(spark, sf_dir, conforming, dimension, vehicle):
    """Both batches through conform, split, dimension and history merge."""
    first, second = (
        stage(
            dimension(
                conform.split_listings(
                    conforming(v.raw_listings(spark, sf_dir, vehicle=vehicle, posting=i), v.run_stamp(day))
                )[0]
            ),
            f"batch-{i}",
        )
        for i, day in enumerate(("2026-01-01", "2026-01-08"))
    )
    stamp, open_end = v.run_stamp(), F.lit(None).cast("timestamp")
    start = first.select("*", stamp.alias("valid_from"), open_end.alias("valid_to"))
    return _ntz(merge.scd2_apply(start, second, v.run_stamp("2026-01-08")))


@query(
    "phone_gold_cost",
    _gold_sql(
        "cost",
        [
            "coalesce(Currency, 'CAD') AS currency",
            "CAST(coalesce(TRY_CAST(Price AS DECIMAL(18,2)), 0) AS DECIMAL(18,2)) AS price",
        ],
        "length(currency) = 3 AND price >= 0",
    ),
)
def phone_gold_cost(spark, sf_dir):
    return _two_runs(spark, sf_dir, conform.conform_phone, dimensions.cost, vehicle=False)


@query(
    "motorcycle_gold_odometer",
    _gold_sql(
        "odometer",
        [
            "lower(replace(OdometerUnits, 'KMT', 'KM')) AS units",
            "TRY_CAST(Odometer AS INTEGER) AS odometer",
        ],
        "units IN ('km', 'mi') AND odometer >= 0",
    ),
)
def motorcycle_gold_odometer(spark, sf_dir):
    return _two_runs(spark, sf_dir, conform.conform_motorcycle, dimensions.odometer, vehicle=True)


@query(
    "gold_listing",
    v.with_(v.RAW_SQL)
    + """SELECT TRY_CAST(ID AS BIGINT) AS id, 'Product' AS category, TRY_CAST("Date" AS DATE) AS posted_at,
           CASE posting WHEN 0 THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2026-01-08' END AS processed_at FROM raw
         WHERE TRY_CAST(ID AS BIGINT) IS NOT NULL AND TRY_CAST("Date" AS DATE) IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY TRY_CAST(ID AS BIGINT) ORDER BY posting DESC) = 1""",
)
def gold_listing(spark, sf_dir):
    first, second = (
        conform.split_listings(
            conform.conform_phone(v.raw_listings(spark, sf_dir, posting=i), v.run_stamp(day))
        )[1]
        for i, day in enumerate(("2026-01-01", "2026-01-08"))
    )
    after = merge.upsert(first, second, ["id"])
    return after.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


# -- quality


@query(
    "pk_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def pk_check(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "null_check",
    L + "SELECT "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ("description", "currency", "price", "date", "title"))
    + " FROM listing",
)
def null_check(spark, sf_dir):
    flat = v.phones(spark, sf_dir).select("info.*", "cost.*", "date")
    return quality.null_counts(flat, ["description", "currency", "price", "date", "title"])


@query(
    "check_rules",
    L + """SELECT count(*) FILTER (NOT lat BETWEEN -90 AND 90) AS lat_range,
           count(*) FILTER (NOT lon BETWEEN -180 AND 180) AS lon_range,
           count(*) FILTER (NOT length(currency) = 3) AS currency_length,
           count(*) FILTER (NOT price >= 0) AS price_not_negative,
           count(*) FILTER (NOT country <> '') AS country_not_blank FROM listing""",
)
def check_rules(spark, sf_dir):
    flat = v.phones(spark, sf_dir, place=True).select("location.country", "location.coordinate.*", "cost.*")
    rules = {
        "lat_range": "lat BETWEEN -90 AND 90",
        "lon_range": "lon BETWEEN -180 AND 180",
        "currency_length": "length(currency) = 3",
        "price_not_negative": "price >= 0",
        "country_not_blank": "country <> ''",
    }
    return quality.check_violations(flat, rules)


# -- relational basics


@query(
    "safe_casts",
    v.with_(v.RAW_SQL)
    + """SELECT ID AS raw_id, "Date" AS raw_date, TRY_CAST(ID AS BIGINT) AS id, TRY_CAST("Date" AS DATE) AS date,
           TRY_CAST(Year AS INTEGER) AS year, TRY_CAST(Odometer AS BIGINT) AS odometer,
           TRY_CAST(Price AS DECIMAL(8,2)) AS price FROM raw""",
)
def safe_casts(spark, sf_dir):
    raw = v.raw_listings(spark, sf_dir, vehicle=True)
    return raw.select(
        F.col("ID").alias("raw_id"),
        F.col("Date").alias("raw_date"),
        F.col("ID").try_cast("bigint").alias("id"),
        F.col("Date").try_cast("date").alias("date"),
        F.col("Year").try_cast("int").alias("year"),
        F.col("Odometer").try_cast("bigint").alias("odometer"),
        F.col("Price").try_cast("decimal(8,2)").alias("price"),
    )


@query(
    "null_defaults",
    L + """SELECT id, coalesce(currency, 'CAD') AS currency, coalesce(price, 0) AS price,
           coalesce(nullif(trim(title), ''), url) AS title, nullif(trim(title), '') IS NULL AS blank_title FROM listing""",
)
def null_defaults(spark, sf_dir):
    flat = v.phones(spark, sf_dir).select("id", "cost.*", "info.title", "info.url")
    title = F.nullif(F.trim("title"), F.lit(""))
    return (
        flat.fillna("CAD", subset=["currency"])
        .fillna(0, subset=["price"])
        .select(
            "id", "currency", "price", F.coalesce(title, "url").alias("title"), title.isNull().alias("blank_title")
        )
    )


@query(
    "regex_masks",
    r"""SELECT p_partkey, p_name, p_brand FROM part WHERE regexp_matches(p_name, '\b(red|blue|hot|old)\b')
        AND NOT regexp_matches(p_name, '(?i)(ROD|anvil)') AND (regexp_matches(p_brand, '(?i)BRAND#1')
        OR p_name ILIKE '%widget%')""",
)
def regex_masks(spark, sf_dir):
    keep = F.col("p_name").rlike(r"\b(red|blue|hot|old)\b")
    discard = F.col("p_name").rlike("(?i)(ROD|anvil)")
    either = F.col("p_brand").rlike("(?i)BRAND#1") | F.col("p_name").rlike("(?i)widget")
    return table(spark, sf_dir, "part").filter(keep & ~discard & either).select("p_partkey", "p_name", "p_brand")


@query(
    "brand_counts",
    """SELECT p_brand, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#5', 'Brand#8', 'Brand#13') AS in_focus,
         count(p_name) AS n_models, count(DISTINCT p_name) AS n_names FROM part GROUP BY p_brand""",
)
def brand_counts(spark, sf_dir):
    focus = ["Brand#1", "Brand#2", "Brand#3", "Brand#5", "Brand#8", "Brand#13"]
    counts = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count("p_name").alias("n_models"), F.countDistinct("p_name").alias("n_names")
    )
    return counts.withColumn("in_focus", F.col("p_brand").isin(focus))


@query(
    "page_budget",
    """WITH q AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)
       SELECT CAST(1 + sum(ceil(n / 50.0)) AS BIGINT) AS catalogue_pages,
              CAST(1 + sum(ceil(n / 50.0) + n) AS BIGINT) AS all_pages FROM q""",
)
def page_budget(spark, sf_dir):
    directory = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return pages.page_budget(directory, "n", MODELS_PER_CATALOGUE_PAGE)


@query("sample_rows", "SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def sample_rows(spark, sf_dir):
    return table(spark, sf_dir, "part").orderBy("p_partkey").limit(5)


@query(
    "profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, count(*) FILTER ({c} IS NULL) AS n_null, "
        f"CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high, "
        + (f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev " if c not in ("p_name", "p_brand")
           else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev ") + "FROM part"
        for c in ("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    ),
)
def profile(spark, sf_dir):
    return quality.profile(table(spark, sf_dir, "part"), ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"])


@query(
    "date_window",
    """SELECT event_id, CAST(ts AS DATE) AS day,
         CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-16' AS in_window, true AS in_unbounded
       FROM events""",
)
def date_window(spark, sf_dir):
    day = F.col("ts").cast("date")
    as_of = date(2024, 1, 15)
    return table(spark, sf_dir, "events").select(
        "event_id",
        day.alias("day"),
        pages.date_window(day, as_of, 7).alias("in_window"),
        pages.date_window(day, as_of, -1).alias("in_unbounded"),
    )
