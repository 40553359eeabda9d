"""Stored pages to the raw tables the jobs read: listings with their ids, and the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mercato.operators import dictionary, pages


def listings_from_pages(search_pages: DataFrame, listing_pages: DataFrame) -> DataFrame:
    """(ID, record columns, url, reject_reason): each card found in ``search_pages (html)`` with the
    record of its page in ``listing_pages (url, html)``. A listing carded on several search pages comes
    once; cards whose page is not stored are left out."""
    cards = pages.listing_cards(search_pages, []).select("listing_id", "url").distinct()
    records = pages.listing_records(listing_pages, ["url"])
    return records.join(cards, "url", "inner").withColumnRenamed("listing_id", "ID")


def split_rejects(scraped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw listings, rejects with their reason)."""
    good = scraped.filter("reject_reason IS NULL").drop("reject_reason")
    return good, scraped.filter("reject_reason IS NOT NULL").select("ID", "url", "reject_reason")


def catalogue_from_pages(maker_pages: DataFrame) -> DataFrame:
    """(brand, model, url), one row per brand and model, from ``maker_pages (brand, html)``."""
    return dictionary.clean_catalogue(pages.list_items(maker_pages, ["brand"]))
