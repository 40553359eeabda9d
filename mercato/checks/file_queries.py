"""Sources and sinks: tables written out and read back through the readers."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from mercato import schemas
from mercato.checks import views as v
from mercato.checks.registry import query
from mercato.operators.conform import SOURCE
from mercato.session import staging_dir
from mercato.sources import readers, writers

DAY = date(2026, 1, 1)


def _folder(spark, name):
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "landed_json",
    v.with_(v.RAW_SQL)
    + """SELECT ID AS id, Title AS title, Description AS description, Price AS price, Currency AS currency,
           "Date" AS date, Address AS address, Latitude AS lat, url, '01-01-2026-daily-cell.json' AS file_name FROM raw""",
)
def landed_json(spark, sf_dir):
    folder = _folder(spark, "landing")
    writers.land_json(v.raw_listings(spark, sf_dir, place=True), folder, "cell", DAY)
    raw = readers.raw_listings_day(spark, folder, "cell", DAY, schemas.RAW_PHONE, lines=True)
    landed = F.regexp_extract(SOURCE, r"([^/]+)/[^/]+$", 1)
    return raw.select(
        F.col("ID").alias("id"), F.col("Title").alias("title"), F.col("Description").alias("description"),
        F.col("Price").alias("price"), F.col("Currency").alias("currency"), F.col("Date").alias("date"),
        F.col("Address").alias("address"), F.col("Latitude").alias("lat"), "url", landed.alias("file_name"),
    )


@query("csv_dictionary", v.with_(v.MODELS_SQL) + "SELECT brand, model, url, pattern, CAST(length AS VARCHAR) AS length FROM models")
def csv_dictionary(spark, sf_dir):
    path = _folder(spark, "models-csv")
    writers.write_dictionary(v.models(spark, sf_dir).select(*schemas.columns(schemas.RAW_MODELS)), path)
    return readers.raw_dictionary(spark, path, schemas.RAW_MODELS)


#: Names that CSV and JSON have to quote.
_ODD = """p_name || CASE p_partkey % 4 WHEN 0 THEN ' 7" "pro"' WHEN 1 THEN ', a~b' WHEN 2 THEN ', x"' ELSE '' END"""
_NAMES = f"p_brand AS brand, replace({_ODD}, '~', chr(92)) AS model, CAST(p_partkey AS STRING) AS url"


def _names(spark, sf_dir):
    return spark.sql(f"SELECT {_NAMES} FROM {{part}}", part=readers.table(spark, sf_dir, "part"))


@query("csv_quoted", f"SELECT {_NAMES} FROM part")
def csv_quoted(spark, sf_dir):
    """Quotes, commas and backslashes in names, through a CSV dictionary and back."""
    path = _folder(spark, "quoted-csv")
    writers.write_dictionary(_names(spark, sf_dir), path)
    return readers.raw_dictionary(spark, path, schemas.RAW_CATALOGUE)


@query("catalogue_scan", f"SELECT {_NAMES} FROM part")
def catalogue_scan(spark, sf_dir):
    """A product catalogue as pretty JSON arrays, one per brand, read by the catalogue reader."""
    path = _folder(spark, "catalogue")
    one = _names(spark, sf_dir).groupBy("brand").agg(F.to_json(F.collect_list(F.struct("brand", "model", "url")), {"pretty": "true"}).alias("value"))
    one.select("value", F.sha2("brand", 256).alias("of")).repartition("of").write.partitionBy("of").text(path)
    return readers.raw_catalogue(spark, f"{path}/of=*")


@query("raw_files", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS bytes FROM events GROUP BY 1")
def raw_files(spark, sf_dir):
    """The listing of landed files: an empty line, one byte, was landed per event, in a folder per day."""
    path = _folder(spark, "bytes")
    days = readers.table(spark, sf_dir, "events").select(F.col("ts").cast("date").cast("string").alias("day"), F.lit("").alias("value"))
    days.write.partitionBy("day").text(path)
    files = readers.file_listing(spark, path, "*.txt")
    return files.groupBy(F.regexp_extract("path", r"day=(\d{4}-\d{2}-\d{2})", 1).alias("day")).agg(F.sum("length").alias("bytes"))
