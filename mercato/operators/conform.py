"""Raw flat records to typed nested listings, and listings to the columns the dimensions read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.text import squeeze
from mercato.operators.dedup import keep_first_wide
from mercato.sources.framing import SOURCE


def _safe(name: str, kind: str) -> Column:
    return F.col(name).try_cast(kind)


def _common(category: str, processed_at: datetime | Column) -> dict[str, Column]:
    stamp = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)
    return {
        "id": _safe("ID", "bigint"),
        "category": F.lit(category),
        "info": F.struct(
            F.col("Title").alias("title"), F.col("Description").alias("description"), F.col("url").alias("url")
        ),
        "location": F.struct(
            F.col("Country").alias("country"),
            F.col("City").alias("city"),
            F.col("Address").alias("address"),
            F.struct(_safe("Latitude", "double").alias("lat"), _safe("Longitude", "double").alias("lon")).alias(
                "coordinate"
            ),
        ),
        "cost": F.struct(F.col("Currency").alias("currency"), _safe("Price", "double").alias("price")),
        "date": _safe("Date", "date"),
        "processed_at": stamp.cast("timestamp"),
    }


def _latest_per_id(raw: DataFrame, conformed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per id: latest date, then latest snapshot file, then the content hash decides."""
    order = [F.col("date").desc_nulls_last()]
    if SOURCE in raw.columns:
        day = F.regexp_extract(SOURCE, r"(\d{2}-\d{2}-\d{4})-[^/]*$", 1)
        order += [
            F.try_to_timestamp(day, F.lit("dd-MM-yyyy")).desc_nulls_last(),
            F.col(SOURCE).desc_nulls_last(),
        ]
    order.append(F.col("_content"))
    return keep_first_wide(conformed.filter("id IS NOT NULL"), ["id"], order).select(*columns)


def conform_phone(raw: DataFrame, processed_at: datetime | Column) -> DataFrame:
    cols = _common("Product", processed_at)
    return _conform(raw, cols)


def conform_motorcycle(raw: DataFrame, processed_at: datetime | Column) -> DataFrame:
    cols = _common("Motorcycle", processed_at)
    stamp = cols.pop("processed_at")
    cols["model"] = F.struct(
        F.col("Brand").alias("brand"), F.col("Model").alias("name"), _safe("Year", "int").alias("year")
    )
    unit = F.replace("OdometerUnits", F.lit("KMT"), F.lit("KM"))
    cols["odometer"] = F.struct(
        unit.alias("unit"), _safe("Odometer", "double").try_cast("bigint").alias("value")
    )
    cols["processed_at"] = stamp
    return _conform(raw, cols)


def _conform(raw: DataFrame, cols: dict[str, Column]) -> DataFrame:
    content = F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns if c != SOURCE])
    extra = [F.col(SOURCE)] if SOURCE in raw.columns else []
    conformed = raw.select(*[c.alias(n) for n, c in cols.items()], *extra, content.alias("_content"))
    return _latest_per_id(raw, conformed, list(cols))


def rejected_ids(raw: DataFrame) -> DataFrame:
    """Raw rows that conforming leaves out for want of a numeric id."""
    return raw.filter(_safe("ID", "bigint").isNull())


def split_listings(listings: DataFrame, unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """(columns for the dimensions, the listing table): typed, complete, one row per id. ``unique``: the listings hold an id once
    already, as a silver batch does."""
    typed = listings.withColumns(
        {
            "id": _safe("id", "bigint"),
            "category": squeeze(_safe("category", "string")),
            "posted_at": _safe("date", "date"),
            "processed_at": _safe("processed_at", "timestamp"),
        }
    ).dropna(subset=["id", "category", "posted_at", "processed_at"])
    if not unique:
        content = F.xxhash64(*[c for c in typed.columns if c != "id"])
        order = [F.col("processed_at").desc(), F.col("posted_at").desc(), F.col("_content")]
        typed = keep_first_wide(typed.withColumn("_content", content), ["id"], order).drop("_content")
    return (
        typed.drop("category", "posted_at", "date", "processed_at"),
        typed.select("id", "category", "posted_at", "processed_at"),
    )
