"""Reading raw files and tables, schemas always declared."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.text import file_name
from mercato.sources import framing
from mercato.sources.framing import SOURCE

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def raw_json(spark: SparkSession, path: str | list[str], schema: str, lines: bool | None) -> DataFrame:
    """Rows of JSON files. ``lines`` None: files of any form, each record by itself (see framing); True: one object per line, by
    Spark's reader; False: one value per file, which is one task."""
    if lines is None:
        rows = framing.parsed(framing.records(framing.frames(framing.lines(spark, path))), schema)
        return framing.good(rows, schema)
    df = spark.read.schema(schema).option("multiLine", not lines).json(path)
    return df.withColumn(SOURCE, F.col("_metadata.file_path"))


def raw_listings_all(spark: SparkSession, folder: str, schema: str, lines: bool | None = None) -> DataFrame:
    return raw_json(spark, f"{folder.rstrip('/')}/*.json", schema, lines)


def raw_listings_day(
    spark: SparkSession, folder: str, suffix: str, day: date, schema: str, lines: bool | None = None
) -> DataFrame:
    return raw_json(spark, f"{folder.rstrip('/')}/{file_name(day, suffix)}", schema, lines)


def raw_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_CATALOGUE).option("multiLine", True).json(path)


def raw_dictionary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length", "modificationTime")
