import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from mercato.operators import pages


def page(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "n int, html string")


def ad(**changes):
    doc = {
        "@type": "Product",
        "name": "Phone",
        "description": "good </b> phone",
        "offers": {
            "price": "12.50",
            "priceCurrency": "CAD",
            "validFrom": "2026-01-01",
            "availableAtOrFrom": {
                "latitude": "51.0",
                "longitude": -114,
                "address": {"streetAddress": "a", "addressLocality": "b", "addressCountry": "c"},
            },
        },
    }
    doc.update(changes)
    return {k: v for k, v in doc.items() if v != "drop"}


def script(text):
    return f"<html><head><script>var a;</script><script type='application/ld+json'>{text}</script></head></html>"


BIKE = {"brand": {"name": "Honda"}, "model": "CB", "vehicleModelDate": "2001", "mileageFromOdometer": {"value": 5, "unitCode": "KMT"}}


@pytest.mark.parametrize(
    "html, reason",
    [
        (script(json.dumps(ad())), None),
        (script(json.dumps(ad(**{"@type": "Motorcycle"}, **BIKE))), None),
        (script(json.dumps(ad(**{"@type": "Motorcycle"}))), "missing key"),
        (script(json.dumps(ad(**{"@type": "Car"}))), "unknown type"),
        (script(json.dumps(ad(**{"@type": "drop"}))), "missing key"),
        (script(json.dumps(ad(name="drop"))), "missing key"),
        (script(json.dumps(ad(description=None))), None),
        (script(json.dumps(ad(offers={**ad()["offers"], "price": "free"}))), "bad value"),
        (script(json.dumps(ad(offers={**ad()["offers"], "price": None}))), "bad value"),
        (script("{not json"), "not JSON"),
        (script(""), "not JSON"),
        (script(json.dumps(ad()) + "}"), "not JSON"),
        (script(json.dumps(ad()) + "]"), "not JSON"),
        (script(json.dumps(ad()) + "," + json.dumps(ad())), "not JSON"),
        (script("[1]"), "bad value"),
        ("<html><script>x</script></html>", "no script"),
        ("", "no script"),
    ],
)
def test_listing_records(spark, html, reason):
    row = pages.listing_records(page(spark, html), ["n"]).first()
    assert row.reject_reason == reason
    assert (row.Category is None) == (reason is not None)


def test_record_values(spark):
    row = pages.listing_records(page(spark, script(json.dumps(ad(**{"@type": "Motorcycle"}, **BIKE)))), ["n"]).first()
    assert (row.Price, row.Latitude, row.Longitude, row.Description) == (12.5, 51.0, -114.0, "good </b> phone")
    assert (row.Brand, row.Year, row.Odometer, row.OdometerUnits) == ("Honda", "2001", "5", "KMT")


def test_cards(spark, rows):
    html = (
        '<ul data-testid="srp-search-list"><li><div data-testid="listing-card" data-listingid="1"><ul><li>x</li></ul>'
        '<a href="/a" data-testid="listing-link">t</a></div></li><li><div data-testid="listing-card"></div></li>'
        '<li><div class="k" data-testid="listing-card" data-listingid="3"></div></li></ul>'
        '<div data-testid="listing-card" data-listingid="9"><a data-testid="listing-link" href="/9"></a></div>'
    )
    assert rows(pages.listing_cards(page(spark, html, "<p>no list</p>"), ["n"])) == [(0, 1, "1", "/a")]


def header(text, n=2):
    return f'<h2 data-testid="srp-results">{text}</h2>' * n


def test_result_count(spark, rows):
    df = page(
        spark,
        header("Showing 1 - 40 of 1,234 results"),
        header("Showing <b>1,201</b> - 1,234 of&nbsp;1,234 results"),
        header("1 2"),
        header("1 - 2 of 3", 1),
    )
    assert rows(pages.result_count(df, ["n"]), "n") == [
        (0, 1, 40, 1234, False),
        (1, 1201, 1234, 1234, True),
        (2, None, None, None, None),
        (3, None, None, None, None),
    ]


def test_brand_directory_last_wins(spark, rows):
    cell = '<td><a href="{0}">{1}<br><span>{2} devices</span></a></td>'
    html = (
        '<div class="st-text"><table><tr>'
        + cell.format("a.php", "Acer", 100)
        + "<td>odd</td>"
        + cell.format("b.php", "AT&amp;T", 4)
        + cell.format("a2.php", "Acer", 7)
        + "</tr></table></div>"
    )
    got = rows(pages.brand_directory(page(spark, html), ["n"]), "brand")
    assert got == [(0, "AT&T", "b.php", 4), (0, "Acer", "a2.php", 7)]


def test_numbered_links_and_models(spark, rows):
    nav = '<div class="nav-pages"><strong>1</strong><a href="p2">2</a><a>3</a><a href="next">&gt;</a></div><a href="z">9</a>'
    assert rows(pages.numbered_links(page(spark, nav), ["n"])) == [(0, 0, "2", "p2")]
    makers = '<div class="makers"><ul><li><a href="m1"><b>One</b></a></li><li>none</li></ul></div><li><a href="q">q</a></li>'
    assert rows(pages.list_items(page(spark, makers), ["n"])) == [(0, 0, "One", "m1")]


def test_date_window(spark):
    as_of = date(2026, 1, 10)

    def inside(day, n):
        return spark.range(1).select(pages.date_window(F.lit(day).cast("date"), as_of, n)).first()[0]

    assert [inside(d, 2) for d in ("2026-01-07", "2026-01-08", "2026-01-11", "2026-01-12")] == [False, True, True, False]
    assert inside("1999-01-01", -1)


def test_page_budget(spark):
    df = spark.createDataFrame([(50,), (51,), (1,)], "quantity int")
    assert tuple(pages.page_budget(df, "quantity", 50).first()) == (5, 107)
    assert tuple(pages.page_budget(df.limit(0), "quantity", 50).first()) == (1, 1)


def test_long_page_with_deep_lists(spark, rows):
    """Far more nested and sibling elements than a recursive regex could hold."""
    item = "<li><ul><li>x</li></ul></li>"
    html = f'<div class="makers"><ul>{item * 20000}<li><a href="last">end</a></li></ul></div>'
    assert rows(pages.list_items(page(spark, html), ["n"]).select("model", "url")) == [("end", "last")]


def test_listings_from_pages(spark, rows):
    from mercato.plans.pages import listings_from_pages, split_rejects

    card = '<li><div data-testid="listing-card" data-listingid="{0}"><a data-testid="listing-link" href="/{0}">x</a></div></li>'
    search = '<ul data-testid="srp-search-list">' + "".join(card.format(i) for i in (1, 2, 3)) + "</ul>"
    stored = spark.createDataFrame(
        [("/1", script(json.dumps(ad()))), ("/2", "<html></html>"), ("/4", script(json.dumps(ad())))], "url string, html string"
    )
    good, rejects = split_rejects(listings_from_pages(page(spark, search, search), stored))
    assert rows(good.select("ID", "url", "Title")) == [("1", "/1", "Phone")]
    assert rows(rejects) == [("2", "/2", "no script")]


def test_values_of_a_record_are_taken_out_once(spark):
    """Reasons and values of odd records; what kind a record is, and what its price is, is read once and once more where there is none."""
    whole = '"name":"n","description":"d","offers":{"price":%s,"priceCurrency":"CAD","validFrom":"x","availableAtOrFrom":{"latitude":"1.5",' + (
        '"longitude":2,"address":{"streetAddress":"s","addressLocality":"l","addressCountry":"c"}}}'
    )
    docs = {
        "good": ('{"@type":"Product",' + whole % "5" + "}", None, 5.0), "text": ('{"@type":"Product",' + whole % '"7.5"' + "}", None, 7.5),
        "call": ('{"@type":"Product",' + whole % '"call"' + "}", "bad value", None), "list": ("[1]", "bad value", None), "number": ("3", "bad value", None),
        "kindless": ("{" + whole % "5" + "}", "missing key", None), "object kind": ('{"@type":{},' + whole % "5" + "}", "unknown type", None),
        "bike": ('{"@type":"Motorcycle",' + whole % "5" + "}", "missing key", None), "car": ('{"@type":"Car"}', "unknown type", None),
        "two": ('{"@type":"Product"}, {}', "not JSON", None), "empty": ("", "not JSON", None),
    }
    rows = [(k, f'<script type="application/ld+json">{doc}</script>') for k, (doc, _, _) in docs.items()] + [("none", "<p>")]
    found = pages.listing_records(spark.createDataFrame(rows, "url string, html string"), ["url"])
    want = {k: (reason, price) for k, (_, reason, price) in docs.items()} | {"none": ("no script", None)}
    assert {r.url: (r.reject_reason, r.Price) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$['@type']") == 2 and plan.count("$.offers.price,") == 2
