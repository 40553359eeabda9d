"""Page extraction: on the stored pages, and on pages in the listing-site layout rendered from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.checks import views as v
from mercato.checks.registry import query
from mercato.constants import SEARCH_LIST
from mercato.operators import pages
from mercato.plans import pages as page_plans
from mercato.sources.readers import table

_UNESCAPED = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query(
    "page_links",
    r"""WITH m AS (SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>\s*<a\b[^>]*\bhref="([^"]*)"', 1) AS u FROM pages)
        SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, u[i] AS url
        FROM (SELECT page_id, u, unnest(range(1, len(u) + 1)) AS i FROM m)""",
)
def page_links(spark, sf_dir):
    return pages.list_links(table(spark, sf_dir, "pages"), ["page_id"])


@query(
    "list_items",
    r"""WITH n AS (SELECT page_id, regexp_extract(html, '(?is)<nav\b[^>]*>(.*?)</nav>', 1) AS body FROM pages),
        m AS (SELECT page_id, regexp_extract_all(body, '(?is)<li\b[^>]*>(.*?)</li>', 1) AS li FROM n),
        r AS (SELECT page_id, li[i] AS li, i FROM (SELECT page_id, li, unnest(range(1, len(li) + 1)) AS i FROM m))
        SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, """
    + _UNESCAPED.format("regexp_replace(li, '<[^>]*>', '', 'g')")
    + " AS model, "
    + _UNESCAPED.format(r"""regexp_extract(li, '(?is)\bhref="([^"]*)"', 1)""")
    + " AS url FROM r WHERE li ILIKE '%href=%'",
)
def list_items(spark, sf_dir):
    return pages.list_items(table(spark, sf_dir, "pages"), ["page_id"], container=("nav",))


# -- pages in the layout of the listing site, one per part


def _part_pages(spark, sf_dir, html):
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name", "p_brand", "p_type", "p_size", f"{html} AS html")


_CARD = (
    "'<li><section class=\"c\" data-testid=\"listing-card\" data-listingid=\"' || {id} || '\"><ul><li>tag</li></ul>"
    "<a data-testid=\"listing-link\" href=\"/v/' || {url} || '\">' || p_name || '</a></section></li>'"
)
_SEARCH_PAGE = (
    "'<html><ul data-testid=\"srp-top\"><li><section data-testid=\"listing-card\" data-listingid=\"0\"></section></li></ul>"
    f"<ul class=\"x\" data-testid=\"{SEARCH_LIST[2]}\">' || "
    + _CARD.format(id="CAST(p_partkey * 10 AS STRING)", url="p_type || '?a=1&amp;b=' || CAST(p_size AS STRING)")
    + " || CASE WHEN p_size > 25 THEN '<li>advert</li>' ELSE '' END || "
    + _CARD.format(id="CAST(p_partkey * 10 + 1 AS STRING)", url="p_brand")
    + " || '</ul><ul><li><section data-testid=\"listing-card\" data-listingid=\"9\"><a data-testid=\"listing-link\" "
    "href=\"/late\">x</a></section></li></ul></html>'"
)


@query(
    "listing_cards",
    """SELECT p_partkey, 1 AS pos, CAST(p_partkey * 10 AS VARCHAR) AS listing_id,
              '/v/' || p_type || '?a=1&b=' || p_size AS url FROM part
       UNION ALL SELECT p_partkey, 2, CAST(p_partkey * 10 + 1 AS VARCHAR), '/v/' || p_brand FROM part""",
)
def listing_cards(spark, sf_dir):
    return pages.listing_cards(_part_pages(spark, sf_dir, _SEARCH_PAGE), ["p_partkey"])


_TOTAL = "(p_size * 40 + p_partkey % 3 * 100000)"
_COUNT_PAGE = (
    "'<html><h2 data-testid=\"srp-results\">Showing <b>' || CAST(p_size * 40 - 39 AS STRING) || '</b> - ' || "
    "CAST(p_size * 40 AS STRING) || ' of&nbsp;' || {total} || ' results</h2>' || "
    "CASE WHEN p_brand = 'Brand#7' THEN '' ELSE '<h2 data-testid=\"srp-results\">again</h2>' END || '<h2>x</h2></html>'"
)


@query(
    "result_count",
    f"""SELECT p_partkey, CASE WHEN ok THEN p_size * 40 - 39 END AS first, CASE WHEN ok THEN p_size * 40 END AS last,
         CASE WHEN ok THEN CAST({_TOTAL} AS INTEGER) END AS total,
         CASE WHEN ok THEN p_size * 40 = {_TOTAL} END AS is_last
       FROM (SELECT *, p_brand <> 'Brand#7' AS ok FROM part)""",
)
def result_count(spark, sf_dir):
    shown = _COUNT_PAGE.format(total=f"format_number({_TOTAL}, 0)")
    return pages.result_count(_part_pages(spark, sf_dir, shown), ["p_partkey"])


def _brand_cell(name, qty, href):
    return f"'<td><a href=' || {href} || '>' || {name} || '<br><span>' || CAST({qty} AS STRING) || ' devices</span></a></td>'"


_DIRECTORY_PAGE = (
    "'<html><table><tr><td><a href=x>no<br><span>1 d</span></a></td></tr></table><div class=\"a st-text\"><table><tr>' || "
    + _brand_cell("p_brand", "p_size", "'\"b-' || CAST(p_size AS STRING) || '.php\"'")
    + " || "
    + _brand_cell("p_type", "p_partkey", "'\"t.php\"'")
    + " || '</tr><tr><td>empty</td>' || "
    + _brand_cell("CASE WHEN p_size > 40 THEN p_brand ELSE p_name END", "p_size + 1", "'\"last.php\"'")
    + " || '</tr></table></div></html>'"
)


@query(
    "brand_directory",
    """SELECT p_partkey, p_brand AS brand, 'b-' || p_size || '.php' AS url, p_size AS quantity FROM part WHERE p_size <= 40
       UNION ALL SELECT p_partkey, p_type, 't.php', CAST(p_partkey AS INTEGER) FROM part
       UNION ALL SELECT p_partkey, CASE WHEN p_size > 40 THEN p_brand ELSE p_name END, 'last.php', p_size + 1 FROM part""",
)
def brand_directory(spark, sf_dir):
    return pages.brand_directory(_part_pages(spark, sf_dir, _DIRECTORY_PAGE), ["p_partkey"])


_NAV_PAGE = (
    "'<html><a href=\"/0\">0</a><div class=\"nav-pages\"><div><a href=\"/prev\">prev</a></div><strong>1</strong>"
    "<a href=\"/' || p_brand || '\">' || CAST(p_size AS STRING) || '</a><a>7</a>"
    "<a class=\"n\" href=\"/n?a&amp;p=' || CAST(p_partkey AS STRING) || '\">' || CAST(p_partkey AS STRING) || '</a>"
    "<a href=\"/next\">' || p_name || '</a></div><a href=\"/9\">9</a></html>'"
)


@query(
    "numbered_links",
    """SELECT p_partkey, 1 AS pos, CAST(p_size AS VARCHAR) AS page_no, '/' || p_brand AS url FROM part
       UNION ALL SELECT p_partkey, 3, CAST(p_partkey AS VARCHAR), '/n?a&p=' || p_partkey FROM part""",
)
def numbered_links(spark, sf_dir):
    return pages.numbered_links(_part_pages(spark, sf_dir, _NAV_PAGE), ["p_partkey"])


_MAKERS_PAGE = (
    "'<html><ul><li><a href=\"/no\">no</a></li></ul><div id=\"m\" class=\"makers\"><div><ul><li><a href=\"/' || p_brand || "
    "'\"><img src=\"x\"><strong><span>' || p_name || ' &amp; co</span></strong></a></li><li>plain</li>"
    "<li><a href=\"/s\">' || CAST(p_size AS STRING) || '</a></li></ul></div></div><li><a href=\"/no\">no</a></li></html>'"
)


@query(
    "model_list",
    """SELECT p_partkey, p_brand, 0 AS pos, p_name || ' & co' AS model, '/' || p_brand AS url FROM part
       UNION ALL SELECT p_partkey, p_brand, 2, CAST(p_size AS VARCHAR), '/s' FROM part""",
)
def model_list(spark, sf_dir):
    return pages.list_items(_part_pages(spark, sf_dir, _MAKERS_PAGE), ["p_partkey", "p_brand"])


# -- listing pages: every ad as a page with a JSON-LD script, some of them damaged, and the stored pages


def listing_pages(spark, sf_dir):
    raw = v.raw_listings(spark, sf_dir, place=True, vehicle=True)
    kind = F.expr(
        "CASE WHEN Country = '' THEN 'Vehicle' WHEN Brand IS NOT NULL AND OdometerUnits IS NOT NULL THEN 'Motorcycle' ELSE 'Product' END"
    )
    price = F.when(F.col("Currency") == "US", F.lit("call")).otherwise(F.col("Price").cast("string"))
    doc = F.to_json(
        F.struct(
            kind.alias("@type"),
            F.col("Title").alias("name"),
            F.coalesce("Description", F.lit('say "hi" <b>')).alias("description"),
            F.struct(
                price.alias("price"),
                F.col("Currency").alias("priceCurrency"),
                F.col("Date").alias("validFrom"),
                F.struct(
                    F.col("Latitude").alias("latitude"),
                    F.col("Longitude").alias("longitude"),
                    F.struct(
                        F.col("Address").alias("streetAddress"),
                        F.col("City").alias("addressLocality"),
                        F.col("Country").alias("addressCountry"),
                    ).alias("address"),
                ).alias("availableAtOrFrom"),
            ).alias("offers"),
            F.struct(F.col("Brand").alias("name")).alias("brand"),
            F.col("Model").alias("model"),
            F.col("Year").alias("vehicleModelDate"),
            F.struct(F.col("Odometer").alias("value"), F.col("OdometerUnits").alias("unitCode")).alias(
                "mileageFromOdometer"
            ),
        )
    )
    docs = raw.select("url", F.col("Date").alias("day"), "Year", doc.alias("doc"))
    tag = F.when(F.col("Year") == "2000", "<script>").otherwise('<script data-n="1" type="application/ld+json">')
    tail = F.when(F.col("Year") == "1999", "}</script>").otherwise("</script>")
    head, end = F.lit("<html><head><title>ad</title>"), F.lit("</head></html>")
    return docs.select("url", "day", F.concat(head, tag, F.col("doc"), tail, end).alias("html"))


@query(
    "jsonld_extract",
    v.with_(v.RAW_SQL)
    + """, j AS (SELECT *, CASE WHEN Country = '' THEN 'Vehicle'
              WHEN raw_brand IS NOT NULL AND OdometerUnits IS NOT NULL THEN 'Motorcycle' ELSE 'Product' END AS kind FROM raw),
       f AS (SELECT *, CASE WHEN Year = '2000' THEN 'no script' WHEN Year = '1999' THEN 'not JSON'
              WHEN kind = 'Vehicle' THEN 'unknown type'
              WHEN Currency = 'US' THEN 'bad value'
              WHEN Price IS NULL OR Currency IS NULL THEN 'missing key' END AS fault FROM j)
       SELECT url, "Date" AS day, CASE WHEN fault IS NULL THEN kind END AS "Category",
         CASE WHEN fault IS NULL THEN Title END AS "Title",
         CASE WHEN fault IS NULL THEN coalesce(Description, 'say "hi" <b>') END AS "Description",
         CASE WHEN fault IS NULL THEN Price END AS "Price", CASE WHEN fault IS NULL THEN Currency END AS "Currency",
         CASE WHEN fault IS NULL THEN "Date" END AS "Date", CASE WHEN fault IS NULL THEN Address END AS "Address",
         CASE WHEN fault IS NULL THEN City END AS "City", CASE WHEN fault IS NULL THEN Country END AS "Country",
         CASE WHEN fault IS NULL THEN Latitude END AS "Latitude", CASE WHEN fault IS NULL THEN Longitude END AS "Longitude",
         CASE WHEN fault IS NULL AND kind = 'Motorcycle' THEN raw_brand END AS "Brand",
         CASE WHEN fault IS NULL AND kind = 'Motorcycle' THEN raw_model END AS "Model",
         CASE WHEN fault IS NULL AND kind = 'Motorcycle' THEN Year END AS "Year",
         CASE WHEN fault IS NULL AND kind = 'Motorcycle' THEN Odometer END AS "Odometer",
         CASE WHEN fault IS NULL AND kind = 'Motorcycle' THEN OdometerUnits END AS "OdometerUnits",
         fault AS reject_reason FROM f
       UNION ALL SELECT url, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, 'no script' FROM pages""",
)
def jsonld_extract(spark, sf_dir):
    stored = table(spark, sf_dir, "pages").select("url", F.lit(None).cast("string").alias("day"), "html")
    return pages.listing_records(listing_pages(spark, sf_dir).unionByName(stored), ["url", "day"])


# -- whole lineages: search and listing pages to raw listings, maker pages to the catalogue


def search_pages(spark, sf_dir):
    """Each ad on a result page of its own, carded twice."""
    card = (
        "'<li><section data-testid=\"listing-card\" data-listingid=\"' || ID || '\"><a href=\"' || url || "
        "'\" data-testid=\"listing-link\">' || coalesce(Title, '') || '</a></section></li>'"
    )
    html = f"'<ul data-testid=\"{SEARCH_LIST[2]}\">' || {card} || {card} || '</ul>'"
    return v.raw_listings(spark, sf_dir, posting=0).selectExpr(f"{html} AS html")


@query(
    "scraped_listings",
    v.with_(v.RAW_SQL)
    + """, j AS (SELECT *, CASE WHEN Country = '' THEN 'Vehicle'
              WHEN raw_brand IS NOT NULL AND OdometerUnits IS NOT NULL THEN 'Motorcycle' ELSE 'Product' END AS kind FROM raw),
       f AS (SELECT *, CASE WHEN Year = '2000' THEN 'no script' WHEN Year = '1999' THEN 'not JSON'
              WHEN kind = 'Vehicle' THEN 'unknown type' WHEN Currency = 'US' THEN 'bad value'
              WHEN Price IS NULL OR Currency IS NULL THEN 'missing key' END AS fault FROM j)
       SELECT ID AS "ID", url, CASE WHEN fault IS NULL THEN kind END AS "Category",
         CASE WHEN fault IS NULL THEN Title END AS "Title", CASE WHEN fault IS NULL THEN Price END AS "Price",
         fault AS reject_reason FROM f""",
)
def scraped_listings(spark, sf_dir):
    listings = listing_pages(spark, sf_dir).select("url", "html")
    scraped = page_plans.listings_from_pages(search_pages(spark, sf_dir), listings)
    return scraped.select("ID", "url", "Category", "Title", "Price", "reject_reason")


@query(
    "scraped_catalogue",
    """SELECT p_brand AS brand, p_name || ' & co' AS model, min('/' || p_brand) AS url FROM part GROUP BY ALL
       UNION ALL SELECT DISTINCT p_brand, CAST(p_size AS VARCHAR), '/s' FROM part""",
)
def scraped_catalogue(spark, sf_dir):
    makers = _part_pages(spark, sf_dir, _MAKERS_PAGE).select(F.col("p_brand").alias("brand"), "html")
    return page_plans.catalogue_from_pages(makers)
