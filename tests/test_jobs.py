"""Sources, sinks, the daily jobs and the streaming ingest over a temporary warehouse."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from mercato import schemas
from mercato.operators import dictionary, quality
from mercato.plans import jobs
from mercato.sources import readers, tables, writers
from mercato.streaming.daily import ingest_new_files

DAY1, DAY2 = datetime(2026, 1, 1, 6), datetime(2026, 1, 2, 6)


def ad(id, title, price=10.0, **more):
    return {
        "ID": str(id), "Category": "Product", "Title": title, "Description": "128 gb", "Price": price, "Currency": "CAD",
        "Date": "2026-01-01", "Address": "Calgary, T2X1A1", "City": "Calgary", "Country": "Canada", "Latitude": 51.0,
        "Longitude": -114.0, "url": f"/{id}", **more,
    }


def land(folder, name, ads):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(ads, indent=4))


@pytest.fixture()
def warehouse(spark):
    for name in ("silver", "gold"):
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    tables.create_silver(spark)
    tables.create_gold(spark)
    tables.create_gold(spark)  # again: nothing happens
    return spark


def test_daily_phone_jobs(warehouse, tmp_path, rows):
    spark = warehouse
    brands = dictionary.alias_dictionary(spark)
    models = spark.createDataFrame([("Apple", "13", "/13", r"\b13\b", "2")], schemas.RAW_MODELS)
    jobs.update_dictionaries(spark, brands, models)
    assert spark.table("silver.cell_brands").count() == 20

    folder = tmp_path / "raw"
    land(folder, "01-01-2026-daily-cell.json", [ad(1, "iPhone 13"), ad(2, "Galaxy", 5.0), ad("x", "bad id")])
    report = jobs.ingest(spark, str(folder), "cell", DAY1)
    assert tuple(report.first()) == (3, 1)
    jobs.update_gold(spark, "cell", DAY1)
    assert rows(spark.table("gold.electronic_brand").select("id", "brand", "model"), "id") == [
        (1, "Apple", "13"), (2, "Samsung", None),
    ]
    assert rows(spark.table("gold.storage").select("id", "storage_gb"), "id") == [(1, 128), (2, 128)]
    assert rows(spark.table("gold.location").select("address", "postal_code").distinct()) == [("Calgary", "T2X 1A1")]

    land(folder, "02-01-2026-daily-cell.json", [ad(1, "iPhone 13", 8.0), ad(3, "Pixel")])
    jobs.ingest(spark, str(folder), "cell", DAY2)
    assert spark.table("silver.cell_listings").count() == 3
    for _ in range(2):  # a repeated run changes nothing
        jobs.update_gold(spark, "cell", DAY2)
        cost = spark.table("gold.cost")
        assert rows(cost.select("id", F.col("price").cast("double"), "valid_from", "valid_to"), "id", "valid_from") == [
            (1, 10.0, DAY1, DAY2), (1, 8.0, DAY2, None), (2, 5.0, DAY1, None), (3, 10.0, DAY2, None),
        ]
        assert spark.table("gold.listing").count() == 3
    for name, ddl in schemas.DIMENSIONS.items():
        df = spark.table(f"gold.{name}")
        assert quality.duplicate_keys(df, ["id", "valid_from"]).count() == 0
        assert sum(quality.null_counts(df, schemas.required(ddl)).first()) == 0
        assert sum(quality.check_violations(df, schemas.CHECKS[name]).first()) == 0

    paths = writers.export_csv(spark, str(tmp_path / "export"), "gold", files=1)
    assert len(paths) == 8
    back = spark.read.option("header", True).csv(f"{tmp_path}/export/cost")
    assert back.columns == schemas.columns(schemas.DIMENSIONS["cost"]) and back.count() == 4


def test_interrupted_run_is_repeated(warehouse, tmp_path, rows, monkeypatch):
    """A run that wrote the closed versions but not the open ones, then runs again."""
    spark = warehouse
    def batch(price):
        return spark.createDataFrame([(1, "CAD", price, str(price))], "id bigint, currency string, price double, hash string").select(
            "id", "currency", F.col("price").cast("decimal(18,2)"), "hash"
        )

    tables.apply_scd2(batch(1.0), "gold.cost", DAY1)
    with monkeypatch.context() as patch:
        def die(*_):
            raise RuntimeError("lost")

        patch.setattr(tables, "replace_contents", die)
        with pytest.raises(RuntimeError):
            tables.apply_scd2(batch(2.0), "gold.cost", DAY2)
    tables.apply_scd2(batch(2.0), "gold.cost", DAY2)
    assert rows(spark.table("gold.cost").select("hash", "valid_from", "valid_to"), "valid_from") == [
        ("1.0", DAY1, DAY2), ("2.0", DAY2, None),
    ]


def test_motorcycle_jobs_and_missed_batches(warehouse, tmp_path, rows):
    spark = warehouse
    folder = tmp_path / "moto"
    extra = dict(Brand="Honda", Model="CB", Year="2001", Odometer=1500, OdometerUnits="KMT")
    land(folder, "01-01-2026-daily-motorcycle.json", [ad(1, "a", **extra), ad(2, "b", **extra)])
    jobs.ingest(spark, str(folder), "motorcycle", DAY1)
    land(folder, "02-01-2026-daily-motorcycle.json", [ad(2, "b", **{**extra, "Odometer": "1600"})])
    jobs.ingest(spark, str(folder), "motorcycle", DAY2)
    jobs.update_gold(spark, "motorcycle", DAY2, since=datetime(2025, 1, 1))
    got = rows(spark.table("gold.odometer").select("id", "units", "odometer", "valid_from", "valid_to"), "id", "valid_from")
    assert got == [(1, "km", 1500, DAY1, None), (2, "km", 1500, DAY1, DAY2), (2, "km", 1600, DAY2, None)]  # both missed days of id 2
    assert rows(spark.table("gold.vehicle_spec").select("id", "brand", "model", "year"), "id") == [
        (1, "Honda", "CB", 2001), (2, "Honda", "CB", 2001),
    ]


def test_unknown_category(spark):
    with pytest.raises(ValueError, match="category"):
        jobs.ingest(spark, "/nowhere", "boat", DAY1)
    with pytest.raises(ValueError, match="category"):
        jobs.update_gold(spark, "boat", DAY1)


def test_empty_day_and_all_files(spark, tmp_path):
    land(tmp_path / "r", "01-01-2026-daily-cell.json", [])
    land(tmp_path / "r", "02-01-2026-daily-cell.json", [ad(1, "a"), ad(2, "b")])
    empty = readers.raw_listings_day(spark, str(tmp_path / "r"), "cell", date(2026, 1, 1), schemas.RAW_PHONE)
    assert empty.count() == 0 and "ID" in empty.columns
    assert readers.raw_listings_all(spark, str(tmp_path / "r"), schemas.RAW_PHONE).count() == 2
    files = readers.file_listing(spark, str(tmp_path / "r"), "*.json")
    assert files.columns == ["path", "length", "modificationTime"] and files.count() == 2


def test_landing_is_readable_and_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("1", "t")], "ID string, Title string")
    path = writers.land_json(df, str(tmp_path), "cell", date(2026, 1, 1))
    assert path.endswith("/01-01-2026-daily-cell.json")
    raw = readers.raw_listings_day(spark, str(tmp_path), "cell", date(2026, 1, 1), schemas.RAW_PHONE, lines=True)
    assert raw.select("ID", "Title").collect() == [("1", "t")]
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        writers.land_json(df, str(tmp_path), "cell", date(2026, 1, 1))


def test_dictionary_csv_keeps_patterns(spark, tmp_path, rows):
    df = dictionary.alias_dictionary(spark)
    writers.write_dictionary(df, str(tmp_path / "brands"))
    assert rows(readers.raw_dictionary(spark, str(tmp_path / "brands"), schemas.RAW_BRANDS), "brand") == rows(df, "brand")
    plain = tmp_path / "plain.csv"
    plain.write_text('brand,pattern\nOnePlus,\\bone\\s*plus\\b\nLG,"\\blg\\b"\n')
    assert rows(readers.raw_dictionary(spark, str(plain), schemas.RAW_BRANDS), "brand") == [
        ("LG", r"\blg\b"), ("OnePlus", r"\bone\s*plus\b"),
    ]


def test_clean_dictionaries(spark, rows):
    raw = spark.createDataFrame(
        [("  A ", "p1"), ("A", "p0"), ("B", "p0"), ("C", ""), (None, "x"), ("D", None), (" ", "y")], schemas.RAW_BRANDS
    )
    assert rows(dictionary.clean_brands(raw)) == [("A", "p0")]
    models = spark.createDataFrame(
        [("A", "m  1", "u", "p", "2"), ("A", "m 1", "t", "p", "2"), ("A", "n", "u", "p", "1"), ("A", "o", "u", "q", "x")],
        schemas.RAW_MODELS,
    )
    assert rows(dictionary.clean_models(models)) == [("A", "m 1", "p", 2, "t")]
    names = spark.createDataFrame([(" A", "m", "z"), ("A", " m", "b"), ("A", "", "c")], schemas.RAW_CATALOGUE)
    assert rows(dictionary.clean_catalogue(names)) == [("A", "m", "b")]
    assert dictionary.focus(spark.createDataFrame([("LG",), ("Acer",)], "brand string")).count() == 1


@pytest.mark.parametrize(
    "brand, name, model, pattern",
    [
        ("Apple", "Apple iPhone 5c (2013)", "Apple 5c", r"\bapple\s*5\s*c\b"),
        ("Apple", "iPhone SE", "SE", r"\bse\b"),
        ("Samsung", "Galaxy A02s 5G", "A02s", r"\ba0?2\s*s\b"),
        ("Samsung", "Galaxy S20+", "S20+", r"\bs\s*20\s*plus\b"),
        ("Google", "Pixel", "1", r"\b1\b"),
        ("Google", "Pixel 7 Pro 5G", "7 Pro", r"\b7\s*pro\b"),
        ("Motorola", "Moto G7s (2nd)", "G7s", r"\bg\s*7\s*s\b"),
        ("LG", "G8 ThinQ", "G8", r"\bg\s*8\b"),
        ("LG", "Stylo 6 A", "Stylo 6 A", r"\bstylo\s*6a\b"),
        ("OnePlus", "Nord CE2 Lite 5G", "Nord CE2 Lite", r"\bnord\s*ce\s*2\s*lite\b"),
        ("OnePlus", "8T+ 5G McLaren", "8T+", None),
    ],
)
def test_model_dictionary(spark, brand, name, model, pattern):
    row = dictionary.model_dictionary(spark.createDataFrame([(brand, name, "u")], schemas.RAW_CATALOGUE)).first()
    assert row.model == model and row.length == len(model.replace(" ", ""))
    assert pattern is None or row.pattern == pattern


def test_model_dictionary_discards(spark):
    names = [
        ("Apple", "iPad 2"), ("Apple", "iPhone"), ("Samsung", "Galaxy Tab"), ("Samsung", "E1200"), ("Google", "Pixel C"),
        ("Motorola", "Charm"), ("Motorola", "Moto 360"), ("LG", "X210"), ("LG", "G2 LTE"), ("OnePlus", "Pad"), ("HTC", "One"),
    ]
    df = spark.createDataFrame([(b, n, "u") for b, n in names], schemas.RAW_CATALOGUE)
    assert dictionary.model_dictionary(df).count() == 0


def test_upsert_table_merges_where_rows_can_change(warehouse, monkeypatch):
    """Formats with row-level operations get a MERGE; Parquet refuses it, which shows the statement ran."""
    spark = warehouse
    batch = spark.createDataFrame([("A", "p")], schemas.RAW_BRANDS)
    monkeypatch.setattr(tables, "_provider", lambda *_: "delta")
    with pytest.raises(Exception, match="MERGE"):
        tables.upsert_table(batch, "silver.cell_brands", ["brand"])


def test_streaming_ingest(warehouse, tmp_path, rows):
    spark = warehouse
    folder, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    land(folder, "01-01-2026-daily-cell.json", [ad(1, "a"), ad(2, "b")])
    for _ in range(2):
        ingest_new_files(spark, str(folder), "cell", checkpoint).awaitTermination(120)
    land(folder, "02-01-2026-daily-cell.json", [ad(2, "B", Date="2026-01-02"), ad(3, "c")])
    ingest_new_files(spark, str(folder), "cell", checkpoint).awaitTermination(120)
    assert rows(spark.table("silver.cell_listings").select("id", "info.title"), "id") == [(1, "a"), (2, "B"), (3, "c")]


def test_ingest_reads_own_landings_and_arrays_whole(warehouse, tmp_path):
    """With the defaults, every object of every file arrives, whatever the form of the file."""
    spark, folder = warehouse, tmp_path / "raw"
    both = spark.createDataFrame([(str(k), f"t{k}") for k in range(40)], "ID string, Title string").repartition(2)
    writers.land_json(both, str(folder), "cell", date(2026, 1, 1))
    assert jobs.ingest(spark, str(folder), "cell", DAY1).first().rows_read == 40
    assert spark.table("silver.cell_listings").count() == 40
    land(folder, "02-01-2026-daily-cell.json", [ad(k, "x") for k in range(100, 107)])
    (folder / "03-01-2026-daily-cell.json").write_text("\n".join(json.dumps(ad(k, "y")) for k in range(200, 203)))
    for run, n in ((DAY2, 7), (datetime(2026, 1, 3, 6), 3)):
        assert jobs.ingest(spark, str(folder), "cell", run).first().rows_read == n
    assert spark.table("silver.cell_listings").count() == 50
    assert jobs.ingest(spark, str(tmp_path / "raw"), "cell", datetime(2026, 1, 4), all_files=True).first().rows_read == 50


def _info(spark, *rows):
    from mercato.functions.text import row_hash

    columns = schemas.columns(schemas.DIMENSIONS["info"])
    df = spark.createDataFrame(rows, "id bigint, title string")
    df = df.select("id", "title", *[F.lit(None).alias(c) for c in columns if c not in ("id", "title", "hash", "valid_from", "valid_to")])
    return df.withColumn("hash", row_hash("title"))


@pytest.mark.parametrize("dies_at", ["closed", "open"])
def test_a_run_that_died_is_undone_by_a_later_one(warehouse, monkeypatch, dies_at, rows):
    spark = warehouse
    tables.apply_scd2(_info(spark, (1, "a"), (2, "b")), "gold.info", datetime(2026, 1, 1))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "upsert_table" if dies_at == "open" else "_overwrite_partitions", dies)
        with pytest.raises(OSError, match="lost"):
            tables.apply_scd2(_info(spark, (1, "A"), (2, "b")), "gold.info", datetime(2026, 1, 2, 10))
    tables.apply_scd2(_info(spark, (1, "A"), (2, "B")), "gold.info", datetime(2026, 1, 2, 11))
    got = rows(spark.table("gold.info").select("id", "title", F.day("valid_from"), F.hour("valid_to")), "id", "valid_from")
    assert got == [(1, "a", 1, 11), (1, "A", 2, None), (2, "b", 1, 11), (2, "B", 2, None)]
    with pytest.raises(ValueError, match="later"):
        tables.apply_scd2(_info(spark, (1, "z")), "gold.info", datetime(2026, 1, 1))
    with pytest.raises(ValueError, match="more than once"):
        tables.apply_scd2(_info(spark, (1, "z"), (1, "y")), "gold.info", datetime(2026, 1, 3))


def test_csv_names_survive(spark, tmp_path):
    names = ['Tab 7" pro, x', "a\\b", 'say "hi"', "plain"]
    df = spark.createDataFrame([("B", n, "/u", r"\bx\b", "3") for n in names], schemas.RAW_MODELS)
    writers.write_dictionary(df, str(tmp_path / "d"))
    back = readers.raw_dictionary(spark, str(tmp_path / "d"), schemas.RAW_MODELS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
