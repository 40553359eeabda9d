import re
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from mercato import schemas
from mercato.operators import conform, dimensions

RUN = datetime(2026, 1, 2)
LISTING = schemas.SILVER["motorcycle_listings"].replace(" NOT NULL", "")


def listing(spark, *changes):
    base = {
        "id": 1,
        "category": " Product ",
        "info": ("  A  phone ", "  ", "u"),
        "location": ("Canada", "Calgary", "1 Main St, Calgary", (51.0, -114.0)),
        "cost": ("CAD", 10.0),
        "date": date(2026, 1, 1),
        "model": ("Honda", "CB", 2000),
        "odometer": ("KM", 100),
        "processed_at": RUN,
    }
    rows = []
    for i, change in enumerate(changes, 1):
        row = {**base, "id": i, **change}
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, LISTING)


def test_info(spark, rows):
    df = listing(spark, {}, {"info": ("  ", "x", "u")}, {"info": ("t", None, "u")})
    got = rows(dimensions.info(df).drop("hash"), "id")
    assert got == [(1, "A phone", None), (3, "t", None)]


def place(spark, *addresses):
    return listing(spark, *[{"location": ("Canada", "Calgary", a, (51.0, -114.0))} for a in addresses])


def test_location_postal_code(spark, rows):
    df = place(
        spark, "Calgary, AB, T2X1A1", "T2X Calgary", None, "t2x 1a1", "T2X 1A1 x T2X 1A1", "1 St,", "Calgary,,", ""
    )
    got = {r[0]: r[1:] for r in rows(dimensions.location(df).select("id", "address", "postal_code"))}
    assert got == {
        1: ("Calgary, AB", "T2X 1A1"),
        2: ("Calgary", "T2X"),
        4: ("T2X 1A1", "T2X 1A1"),
        5: ("x", "T2X 1A1"),
        6: ("1 St", None),
        7: ("Calgary,", None),
    }


def test_location_limits(spark, rows):
    def at(lat, lon, country="Canada", city="Calgary"):
        return {"location": (country, city, "a", (lat, lon))}

    df = listing(spark, at(90.0, 180.0), at(90.5, 0.0), at(None, 0.0), at(0.0, -181.0), at(0.0, 0.0, ""), at(0.0, 0.0, None))
    assert rows(dimensions.location(df).select("id")) == [(1,)]


def test_cost(spark, rows):
    prices = [("CAD", 1.005), (None, 2.0), ("US", 3.0), ("USD", None), ("CAD", -1.0), ("CAD", 1e30), ("CAD", float("nan"))]
    df = listing(spark, *[{"cost": p} for p in prices])
    got = rows(dimensions.cost(df).drop("hash"), "id")
    zero = Decimal("0.00")
    assert got == [
        (1, "CAD", Decimal("1.01")), (2, "CAD", Decimal("2.00")), (4, "USD", zero), (6, "CAD", zero), (7, "CAD", zero),
    ]
    assert dimensions.imputed_prices(df).first()[0] == 3


def test_vehicle(spark, rows):
    years = [1899, 1900, 2027, 2028, None]
    df = listing(spark, *[{"model": ("Honda", "CB", y)} for y in years], {"model": (None, "CB", 2000)}, {"model": ("H", None, 2000)})
    got = rows(dimensions.vehicle_spec(df, RUN.date()).select("id"), "id")
    assert got == [(2,), (3,)]


def test_odometer(spark, rows):
    values = [("KM", 5), ("mi", 0), ("yd", 5), ("km", -1), (None, 5), ("km", None), ("km", 2**40)]
    df = listing(spark, *[{"odometer": v} for v in values])
    assert rows(dimensions.odometer(df).drop("hash"), "id") == [(1, "km", 5), (2, "mi", 0)]


def raw(spark, *changes):
    base = dict(
        ID="1", Category="Motorcycle", Title="t", Description="d", Price=1.0, Currency="CAD", Date="2026-01-01",
        Address="a", City="c", Country="x", Latitude=1.0, Longitude=2.0, url="u", Brand="Honda", Model="CB",
        Year="2000", Odometer="12.7", OdometerUnits="KMT",
    )
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], schemas.RAW_MOTORCYCLE)


def test_conform_motorcycle(spark):
    df = conform.conform_motorcycle(raw(spark, {}, {"ID": "x"}, {"ID": None}, {"ID": "2", "Odometer": "many"}), RUN)
    first, second = df.orderBy("id").collect()
    assert df.columns == schemas.columns(schemas.SILVER["motorcycle_listings"])
    assert (first.id, first.category, first.odometer.unit, first.odometer.value) == (1, "Motorcycle", "KM", 12)
    assert first.location.coordinate.lon == 2.0 and first.date == date(2026, 1, 1)
    assert second.odometer.value is None


def test_conform_keeps_latest_date_then_latest_file(spark):
    df = raw(spark, {"Title": "old", "Date": "2025-01-01"}, {"Title": "new"}, {"Title": "undated", "Date": "soon"})
    assert conform.conform_phone(df, RUN).first().info.title == "new"
    same = raw(spark, {"Title": "a"}, {"Title": "b"}).withColumn(
        conform.SOURCE,
        F.when(F.col("Title") == "a", "/d/03-01-2026-daily-cell.json").otherwise("/d/28-12-2025-daily-cell.json"),
    )
    assert conform.conform_phone(same, RUN).first().info.title == "a"


def test_rejected_ids(spark):
    assert conform.rejected_ids(raw(spark, {}, {"ID": "ad-7"}, {"ID": None})).count() == 2


def test_split(spark, rows):
    df = listing(spark, {}, {"date": None}, {"category": None}, {})
    columns, listings = conform.split_listings(df.unionAll(df))
    assert rows(listings.select("id", "category"), "id") == [(1, "Product"), (4, "Product")]
    assert columns.columns == ["id", "info", "location", "cost", "model", "odometer"]


def test_dimensions_do_not_shuffle(spark):
    df = listing(spark, {})
    for dim in (
        dimensions.info(df), dimensions.location(df), dimensions.cost(df),
        dimensions.vehicle_spec(df, RUN.date()), dimensions.odometer(df),
    ):
        assert "Exchange" not in dim._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_exchange(spark):
    plan = conform.conform_phone(raw(spark, {}), RUN)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # printed top down: the partial limit runs below the exchange


def _sorted_columns(df):
    """Names of the columns that sorts and windows of a plan carry."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    inputs = re.findall(r"\(\d+\) (?:Sort|Window|WindowGroupLimit)[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert inputs and "SortMergeJoin" not in plan
    return {name.split("#")[0] for x in inputs for name in x.split(", ")}


def test_no_text_is_sorted_to_drop_duplicates(spark):
    raw = spark.createDataFrame([("1", "t", "d", "2026-01-01"), ("1", "u", "e", "2026-01-02"), ("x", "", "", "")], "ID string, Title string, Description string, `Date` string")
    for c in schemas.columns(schemas.RAW_PHONE):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("double" if c in ("Price", "Latitude", "Longitude") else "string"))
    listings = conform.conform_phone(raw, datetime(2026, 1, 3))
    assert [r.info.title for r in listings.collect()] == ["u"]
    columns, listing = conform.split_listings(listings.unionByName(listings))
    assert columns.count() == listing.count() == 1
    for df in (listings, columns, listing):
        assert not {"info", "title", "description", "Title", "Description"} & _sorted_columns(df)


def test_a_place_is_searched_for_its_code_once(spark):
    plan = dimensions.location(place(spark, "1 Main St, T2P 1J9"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[A-Z][0-9][A-Z]") == 1
