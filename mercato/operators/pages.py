"""Records from stored web pages ``(…, html)`` by column expressions over fixed markers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.constants import (
    BRAND_CELL,
    BRAND_TABLE,
    CARD_ID,
    CARD_MARK,
    LINK_MARK,
    MODEL_LIST,
    MOTORCYCLE_FIELDS,
    PAGE_LINKS,
    PRODUCT_FIELDS,
    RESULT_HEADER,
    SEARCH_LIST,
)
from mercato.functions.text import blank_to_null, numbers_in

_JSON_LD = r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json\b[^>]*>(.*?)</script>"""
_JSON_LD_TAG = r"""(?i)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json\b"""
_HREF = r"""(?is)\bhref\s*=\s*["']([^"']*)["']"""
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape(c: Column) -> Column:
    for entity, char in _ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def inner_text(html: Column) -> Column:
    return unescape(F.regexp_replace(html, "<[^>]*>", ""))


def _attribute(name: str, value: str) -> str:
    return rf"""\b{name}\s*=\s*["']?(?:[^"'>]*\s)?{value}(?=["'\s>])"""


def element_body(html: Column, tag: str, name: str | None = None, value: str | None = None) -> Column:
    """What lies inside the first such element, nested elements of the same tag included; NULL without
    one. Linear in the page: the rest of the page is cut at the tag and the depth counted up."""
    mark = rf"[^>]*{_attribute(name, value)}" if name else ""
    rest = blank_to_null(F.regexp_extract(html, rf"(?is)<{tag}\b{mark}[^>]*>(.*)$", 1))
    pieces = F.split(rest, rf"(?i)(?=</?{tag}[\s>])")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("kept"), F.lit(False).alias("closed"))

    def step(acc: Column, piece: Column) -> Column:
        turn = F.when(piece.rlike(rf"(?i)^</{tag}[\s>]"), -1).when(piece.rlike(rf"(?i)^<{tag}[\s>]"), 1)
        depth = acc["depth"] + F.coalesce(turn, F.lit(0))
        closed = acc["closed"] | (depth < 0)
        return F.struct(
            depth.alias("depth"),
            (acc["kept"] + F.when(closed, 0).otherwise(1)).alias("kept"),
            closed.alias("closed"),
        )

    kept = F.aggregate(pieces, start, step)["kept"]
    return F.array_join(F.slice(pieces, F.lit(1), kept), "")


def elements(html: Column, tag: str) -> Column:
    """The non-nested elements of a tag as array<string>, tags included."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)(<{tag}\b[^>]*>.*?</{tag}>)"), F.lit(1))


def _items(body: Column, tag: str) -> Column:
    """The inside of every such element as array<string>; a missing closing tag ends at the next one."""
    pieces = F.filter(F.split(body, rf"(?i)(?=<{tag}[\s>])"), lambda p: p.rlike(rf"(?i)^<{tag}[\s>]"))
    return F.transform(pieces, lambda p: F.regexp_replace(p, rf"(?is)</{tag}>.*$", ""))


def first_href(html: Column) -> Column:
    """href of the first link; NULL without one."""
    anchor = F.regexp_extract(html, r"(?is)(<a\b[^>]*>)", 1)
    return unescape(F.when(anchor.rlike(_HREF), F.regexp_extract(anchor, _HREF, 1)))


# -- JSON-LD records


def json_ld(html: Column) -> Column:
    return F.regexp_extract(html, _JSON_LD, 1)


def listing_records(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, Category, record columns, reject_reason): the typed record of a listing page, or why there
    is none: no script, not JSON, missing key, unknown type, bad value - the first that applies."""
    block = F.col("_block")
    # a block that is found has its tag
    tagged = F.when(block != "", True).otherwise(F.col("_html").rlike(_JSON_LD_TAG))
    parsed = (
        pages.select(*keys, json_ld(F.col(html)).alias("_block"), F.col(html).alias("_html"))
        .select(
            *keys,
            tagged.alias("_tagged"),
            F.try_parse_json(F.concat(F.lit("["), block, F.lit("]"))).alias("_listed"),
            F.try_parse_json(F.concat(F.lit('{"d":'), block, F.lit("}"))).alias("_named"),
        )
        # the parser stops after one value: text that follows it breaks at least one of the wrappings
        .select(
            *keys,
            "_tagged",
            F.when(
                F.col("_named").isNotNull() & F.try_variant_get("_listed", "$[1]", "variant").isNull(),
                F.try_variant_get("_listed", "$[0]", "variant"),
            ).alias("_doc"),
        )
        .select("*", F.try_variant_get("_doc", "$['@type']", "string").alias("_kind"))
    )
    kind, is_motorcycle = F.col("_kind"), F.col("_kind") == "Motorcycle"
    types = {"number": "double", "text": "string"}
    # every value is taken out once; only where there is none of its type it is asked why
    values = [F.try_variant_get("_doc", path, types[how]).alias(f"_{name}") for name, path, how in PRODUCT_FIELDS] + [
        F.when(is_motorcycle, F.try_variant_get("_doc", path, types[how])).alias(f"_{name}") for name, path, how in MOTORCYCLE_FIELDS
    ]
    taken = parsed.select(*keys, "_tagged", "_doc", "_kind", *values)

    def fault(name: str, path: str, how: str) -> Column:
        missing = F.when(F.try_variant_get("_doc", path, "variant").isNull(), "missing key")
        return F.when(F.col(f"_{name}").isNull(), missing.otherwise("bad value") if how == "number" else missing)

    product_faults = [fault(*field) for field in PRODUCT_FIELDS]
    motorcycle_faults = [F.when(is_motorcycle, fault(*field)) for field in MOTORCYCLE_FIELDS]
    no_kind = (
        F.when(F.try_variant_get("_doc", "$['@type']", "variant").isNotNull(), "unknown type")
        .when(F.try_variant_get("_doc", "$", "map<string,variant>").isNull(), "bad value")
        .otherwise("missing key")
    )
    reason = (
        F.when(~F.col("_tagged"), "no script")
        .when(F.col("_doc").isNull(), "not JSON")
        .when(kind.isNull(), no_kind)
        .when(~kind.isin("Product", "Motorcycle"), "unknown type")
        .otherwise(F.coalesce(*product_faults, *motorcycle_faults))
    )
    judged = taken.withColumn("reject_reason", reason)
    good = F.col("reject_reason").isNull()
    columns = [F.when(good, F.col(f"_{name}")).alias(name) for name, _, _ in [*PRODUCT_FIELDS, *MOTORCYCLE_FIELDS]]
    return judged.select(*keys, F.when(good, kind).alias("Category"), *columns, "reject_reason")


# -- search pages


def listing_cards(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, pos, listing_id, url) of each card in the search-result list; cards without id or link
    are left out."""
    body = element_body(F.col(html), *SEARCH_LIST)
    card = rf"""(?i)(?=<[a-z]+\b[^>]*{_attribute("data-testid", CARD_MARK)})"""
    link = rf"""(?is)(<[a-z]+\b[^>]*{_attribute("data-testid", LINK_MARK)}[^>]*>)"""
    cards = pages.select(*keys, F.posexplode(F.split(body, card)).alias("pos", "_card")).filter("pos > 0")
    tag = F.regexp_extract("_card", r"(?s)^(<[^>]*>)", 1)
    anchor = F.regexp_extract("_card", link, 1)
    return cards.select(
        *keys,
        "pos",
        F.regexp_extract(tag, rf"""(?i)\b{CARD_ID}\s*=\s*["']?([^"'\s>]+)""", 1).alias("listing_id"),
        unescape(F.regexp_extract(anchor, _HREF, 1)).alias("url"),
    ).filter("listing_id <> '' AND url <> ''")


def result_count(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, first, last, total, is_last) from the result header; NULLs on a malformed page."""
    tag, name, value = RESULT_HEADER
    headers = F.filter(
        elements(F.col(html), tag), lambda e: e.rlike(rf"(?i)^<{tag}\b[^>]*{_attribute(name, value)}")
    )
    text = F.replace(inner_text(F.col("_headers")[0]), F.lit("\u00a0"), F.lit(" "))
    numbers = F.when(F.size("_headers") == 2, numbers_in(text))
    return (
        pages.select(*keys, headers.alias("_headers"))
        .select(*keys, numbers.alias("_numbers"))
        .select(*keys, F.when(F.size("_numbers") == 3, F.col("_numbers")).alias("_numbers"))
        .select(
            *keys,
            F.col("_numbers")[0].alias("first"),
            F.col("_numbers")[1].alias("last"),
            F.col("_numbers")[2].alias("total"),
            (F.col("_numbers")[1] == F.col("_numbers")[2]).alias("is_last"),
        )
    )


def list_links(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, pos, url): links that open a list item, anywhere on the page."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<li\b[^>]*>\s*<a\b[^>]*\bhref="([^"]*)\""""), F.lit(1))
    return pages.select(*keys, F.posexplode(hrefs).alias("pos", "url"))


# -- catalogue pages


def brand_directory(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, brand, url, quantity) from the cells of the brand table; a brand named twice on a page
    keeps its last cell."""
    table = element_body(element_body(F.col(html), *BRAND_TABLE), "table")
    cells = pages.select(*keys, F.posexplode(_items(table, "td")).alias("pos", "_cell"))
    found = cells.select(
        *keys,
        "pos",
        unescape(F.regexp_extract("_cell", BRAND_CELL, 1)).alias("brand"),
        first_href(F.col("_cell")).alias("url"),
        blank_to_null(F.regexp_extract("_cell", BRAND_CELL, 2)).try_cast("int").alias("quantity"),
    ).filter("brand <> '' AND url IS NOT NULL")
    last = F.max_by(F.struct("url", "quantity"), "pos")
    return found.groupBy(*keys, "brand").agg(last.alias("last")).select(*keys, "brand", "last.*")


def numbered_links(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, pos, page_no, url): navigation links whose text is a number."""
    anchors = elements(element_body(F.col(html), *PAGE_LINKS), "a")
    rows = pages.select(*keys, F.posexplode(anchors).alias("pos", "_a"))
    return rows.select(
        *keys, "pos", inner_text(F.col("_a")).alias("page_no"), first_href(F.col("_a")).alias("url")
    ).filter(F.col("page_no").rlike("^[0-9]+$") & F.col("url").isNotNull())


def list_items(
    pages: DataFrame, keys: list[str], html: str = "html", container: tuple = MODEL_LIST
) -> DataFrame:
    """(keys, pos, model, url): text and first link of each item of the model list."""
    items = _items(element_body(F.col(html), *container), "li")
    rows = pages.select(*keys, F.posexplode(items).alias("pos", "_li"))
    return rows.select(
        *keys, "pos", inner_text(F.col("_li")).alias("model"), first_href(F.col("_li")).alias("url")
    ).filter("url IS NOT NULL")


def date_window(day: Column, as_of: date, days: int) -> Column:
    """Whether a date lies in the last ``days`` days up to tomorrow; always true for negative ``days``."""
    if days < 0:
        return F.lit(True)
    today = F.lit(as_of)
    return day.between(F.date_sub(today, days), F.date_add(today, 1))


def page_budget(directory: DataFrame, quantity: str, per_page: int) -> DataFrame:
    """Requests to read a directory: its own page and every catalogue page, without and with the page
    of each model."""
    pages = F.sum(F.ceil(F.col(quantity) / per_page))
    return directory.agg(
        (F.lit(1) + F.coalesce(pages, F.lit(0))).cast("bigint").alias("catalogue_pages"),
        (F.lit(1) + F.coalesce(pages + F.sum(quantity), F.lit(0))).cast("bigint").alias("all_pages"),
    )
