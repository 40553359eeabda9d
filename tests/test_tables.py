"""Bucketed tables, histories whose runs come in any order, batches, pointers set as one."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.text import row_hash
from mercato.operators import merge
from mercato.plans import jobs
from mercato.sources import tables

START = datetime(2026, 1, 1, 6)
DDL = "id bigint NOT NULL, v string, hash string NOT NULL, valid_from timestamp NOT NULL, valid_to timestamp"


def day(n):
    return START + timedelta(days=n)


@pytest.fixture()
def schema(spark):
    for name in ("t", "s", "g"):
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    spark.sql("CREATE SCHEMA t")
    return "t"


def files(spark, table):
    return {r[0]: r[1] for r in spark.table(table).groupBy("bucket").agg(F.sort_array(F.collect_set("_metadata.file_path"))).collect()}


def listing(spark, ids, category="Product"):
    return spark.createDataFrame([(k, category, day(0).date(), day(0)) for k in ids], schemas.LISTING.replace(" NOT NULL", ""))


def test_an_upsert_leaves_other_buckets_alone(spark, schema):
    tables._keyed(spark, "t.listing", schemas.LISTING, "parquet", 8)
    tables.upsert_table(listing(spark, range(200)), "t.listing", ["id"])
    before = files(spark, "t.listing")
    assert set(before) == set(range(8)) and all(len(x) == 1 for x in before.values())
    tables.upsert_table(listing(spark, [7], "Motorcycle"), "t.listing", ["id"])
    after = files(spark, "t.listing")
    assert [b for b in before if before[b] != after[b]] == [spark.range(7, 8).select(tables.bucket_of(8)).first()[0]]
    got = tables.rows(spark, "t.listing")
    assert got.count() == 200 and got.filter("category = 'Motorcycle'").select("id").collect() == [(7,)]
    tables.upsert_table(listing(spark, []), "t.listing", ["id"])
    assert files(spark, "t.listing") == after


def test_a_bucketed_table_joins_without_an_exchange(spark, schema):
    tables._keyed(spark, "t.listing", schemas.LISTING, "parquet", 8)
    tables.upsert_table(listing(spark, range(200)), "t.listing", ["id"])
    batch = listing(spark, range(100, 300))
    after = tables.bucket_upsert(spark.table("t.listing"), batch, [1, 2, 3], 8)
    plan = after._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scan) == 1 and "Bucketed: true" in scan[0] and "bucket" in scan[0].split("PartitionFilters: ")[1].split("]")[0]
    assert plan.count("Exchange") == 1  # the batch's
    assert plan.index("FileScan") < plan.index("Exchange")  # not above the scan


def states(spark, told):
    df = spark.createDataFrame(list(told.items()), "id bigint, v string")
    return df.withColumn("hash", row_hash("v"))


def history(spark, name="t.d"):
    return sorted((r.id, r.valid_from, r.valid_to, r.v) for r in spark.table(name).collect())


def folded(batches):
    """All versions of batches {time: {id: value}} taken in order of time."""
    out = []
    for k in {k for b in batches.values() for k in b}:
        runs = []
        for t in sorted(batches):
            if k in batches[t] and (not runs or runs[-1][1] != batches[t][k]):
                runs.append((t, batches[t][k]))
        out += [(k, t, until, v) for (t, v), until in zip(runs, [t for t, _ in runs[1:]] + [None])]
    return sorted(out)


def test_runs_in_any_order_give_one_history(spark, schema):
    rng = random.Random(4)
    batches = {day(n): {k: rng.choice("ab") for k in rng.sample(range(6), rng.randint(2, 6))} for n in range(4)}
    want = folded(batches)
    for turn in range(2):
        order = rng.sample(sorted(batches), 4)
        tables.create_dimension(spark, f"t.d{turn}", DDL, buckets=2)
        for t in order:
            tables.apply_scd2(states(spark, batches[t]), f"t.d{turn}", t)
        again = rng.choice(order)
        tables.apply_scd2(states(spark, batches[again]), f"t.d{turn}", again)  # a replay changes nothing
        assert history(spark, f"t.d{turn}") == want, order


def test_late_states(spark, schema):
    tables.create_dimension(spark, "t.d", DDL, buckets=2)
    for n, told in ((0, {1: "a", 2: "x"}), (4, {1: "b"}), (8, {1: "c"})):
        tables.apply_scd2(states(spark, told), "t.d", day(n))
    tables.apply_scd2(states(spark, {1: "z", 2: "x"}), "t.d", day(2))  # splits [0, 4)
    tables.apply_scd2(states(spark, {1: "c"}), "t.d", day(6))  # what day 8 repeats begins earlier
    tables.apply_scd2(states(spark, {1: "a", 3: "n"}), "t.d", day(-1))  # before all
    assert history(spark) == [
        (1, day(-1), day(2), "a"), (1, day(2), day(4), "z"), (1, day(4), day(6), "b"), (1, day(6), None, "c"), (2, day(0), None, "x"),
        (3, day(-1), None, "n"),
    ]
    with pytest.raises(ValueError, match="later"):
        tables.apply_scd2(states(spark, {1: "other"}), "t.d", day(4))
    tables.apply_scd2(states(spark, {}), "t.d", day(9))
    assert tables.partitions(spark, "t.d_closed") == [tables.name_of(spark, day(n)) for n in (2, 4, 6)]


def test_a_run_in_order_reads_no_closed_partition(spark, schema, monkeypatch):
    tables.create_dimension(spark, "t.d", DDL, buckets=2)
    for n in range(3):
        tables.apply_scd2(states(spark, {1: f"v{n}", 2: "same"}), "t.d", day(n))
    late = spark.table("t.d_closed").filter(F.col("closed_run") >= tables.name_of(spark, day(3)))
    assert late.inputFiles() == []


def test_an_ended_version_stays_ended(spark):
    columns = ["id", "v", "hash", "valid_from", "valid_to"]
    stored = spark.createDataFrame([(1, "a", "h", day(0), day(3)), (2, "a", "h", day(0), day(3))], DDL.replace(" NOT NULL", ""))
    told = spark.createDataFrame([(1, "a", "h", day(5)), (2, "b", "g", day(1))], "id bigint, v string, hash string, valid_from timestamp")
    got = sorted(tuple(r) for r in merge.scd2_splice(stored, told, columns).drop("hash").collect())
    assert got == [(1, "a", day(0), day(3)), (1, "a", day(5), None), (2, "a", day(0), day(1)), (2, "b", day(1), day(3))]


@pytest.mark.parametrize("done", [0, 2])
def test_pointers_are_set_as_one(spark, schema, monkeypatch, done):
    """A run that dies while it sets pointers is finished by the next, whatever that one brings."""
    tables.create_dimension(spark, "t.d", DDL, buckets=2)
    tables.apply_scd2(states(spark, {1: "a", 2: "x", 3: "u"}), "t.d", day(0))
    real = tables.set_pointers

    def dies(session, moves):
        real(session, moves[:done])
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "set_pointers", dies)
        with pytest.raises(OSError, match="lost"):
            tables.apply_scd2(states(spark, {1: "b", 2: "y", 3: "w"}), "t.d", day(1))
    tables.apply_scd2(states(spark, {9: "new"}), "t.d", day(2))
    assert not tables.recover(spark, "t.d_open")
    assert history(spark) == folded({day(0): {1: "a", 2: "x", 3: "u"}, day(1): {1: "b", 2: "y", 3: "w"}, day(2): {9: "new"}})


def test_broken_rules_stop_a_run(spark, schema):
    tables.create_gold(spark, "g", buckets=2)
    good = spark.createDataFrame([(1, "CAD", "1.00"), (2, "USD", "2.00")], "id bigint, currency string, price string")
    good = good.withColumn("price", F.col("price").cast("decimal(18,2)")).withColumn("hash", row_hash("currency", "price"))
    assert tables.apply_scd2(good, "g.cost", day(0))["rows"] == 2
    for bad in (good.withColumn("currency", F.lit("CA")), good.withColumn("price", F.lit(None).cast("decimal(18,2)")), good.withColumn("price", -F.col("price"))):
        with pytest.raises(ValueError, match="breaks its rules.*2 rows"):
            tables.apply_scd2(bad, "g.cost", day(1))
    assert spark.table("g.cost").count() == 2


def ads(folder, name, rows):
    base = {"Category": "Product", "Description": "128 gb", "Currency": "CAD", "Date": "2026-01-01", "Address": "Calgary", "City": "Calgary",
            "Country": "Canada", "Latitude": 51.0, "Longitude": -114.0, "Brand": "Honda", "Model": "CB", "Year": "2001", "Odometer": "15", "OdometerUnits": "KM"}
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps([{**base, "ID": str(k), "Title": f"t{k}", "Price": p, "url": f"/{k}"} for k, p in rows.items()]))


def test_both_categories_in_one_gold_schema(spark, schema, tmp_path, monkeypatch):
    """The two of a day with one clock, and catching up one after the other."""
    store = jobs._store
    monkeypatch.setattr(jobs, "_store", lambda *x: store(*x[:-1], {"cost": x[-1]["cost"]}))
    told = {"cell": {0: {1: 1.0, 2: 2.0}, 1: {1: 1.5, 3: 3.0}}, "motorcycle": {0: {11: 1.0}, 1: {11: 9.0, 12: 2.0}}}
    tables.create_silver(spark, "s", buckets=2)
    for category, days in told.items():
        for n, rows in days.items():
            ads(tmp_path / category, f"{day(n):%d-%m-%Y}-daily-{category}.json", rows)
            report = jobs.ingest_report(spark, str(tmp_path / category), category, day(n), schema="s").first()
            assert report.rows_read == report.rows_stored == len(rows) and report.broken_record == 0
    assert tables.rows(spark, "s.cell_listings").count() == 3
    assert tables.batch_rows(spark, "s.cell_listings").inputFiles() and len(tables.batch_times(spark, "s.cell_listings")) == 2
    plan = tables.batch_rows(spark, "s.cell_listings")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch#" in plan
    read = tables.batch_rows(spark, "s.cell_listings").inputFiles()
    assert all(f"batch={tables.name_of(spark, day(1))}" in x for x in read)

    histories = []
    for turn in ("same clock", "catch up"):
        spark.sql("DROP SCHEMA IF EXISTS g CASCADE")
        tables.create_gold(spark, "g", buckets=2)
        if turn == "same clock":
            for n in (0, 1):
                for category in ("motorcycle", "cell") if n else ("cell", "motorcycle"):
                    jobs.update_gold(spark, category, day(n), since=None, silver="s", gold="g") if n else jobs.GOLD_JOBS[category](spark, day(0), day(0), "s", "g")
        else:
            for category in ("cell", "motorcycle"):
                jobs.update_gold(spark, category, day(5), since=day(-1), silver="s", gold="g")
        histories.append(sorted((r.id, float(r.price), r.valid_from, r.valid_to) for r in spark.table("g.cost").collect()))
        assert spark.table("g.listing").count() == 5
    assert histories[0] == histories[1] == [
        (1, 1.0, day(0), day(1)), (1, 1.5, day(1), None), (2, 2.0, day(0), None), (3, 3.0, day(1), None), (11, 1.0, day(0), day(1)),
        (11, 9.0, day(1), None), (12, 2.0, day(1), None),
    ]


def test_ingest_counts_and_keeps_what_it_rejects(spark, schema, tmp_path):
    tables.create_silver(spark, "s", buckets=2)
    folder = tmp_path / "raw files"
    folder.mkdir()
    lines = [json.dumps({"ID": str(k), "Title": "t", "Price": 1.0, "Date": "2026-01-01"}) for k in range(100)]
    lines[3] = json.dumps({"ID": "ad-3", "Price": None, "Date": "soon"})
    (folder / f"{day(0):%d-%m-%Y}-daily-cell.json").write_text("\n".join([*lines[:50], "null", *lines[50:], lines[0][:20]]))
    for _ in range(2):  # the same run again replaces its batch
        report = jobs.ingest_report(spark, str(folder), "cell", day(0), schema="s").first().asDict()
        want = {"rows_read": 100, "rows_without_id": 1, "rows_without_price": 1, "rows_without_currency": 100, "bad_date": 1, "broken_record": 1,
                "not_in_a_record": 1, "not_json": 0, "rows_stored": 99}
        assert report == want
        assert spark.table("s.cell_listings").count() == spark.table("s.cell_listings_batches").count() == 99
        assert sorted((r.kind, r.reason, r.text) for r in spark.table("s.rejects").collect()) == [
            ("cell_listings", "broken record", lines[0][:20]), ("cell_listings", "not in a record", "null"),
        ]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        jobs.ingest_report(spark, str(folder), "cell", day(1), schema="s")


def test_keys_of_which_nothing_is_known_are_not_spliced(spark, schema, monkeypatch):
    told, plain = [], merge.scd2_splice

    def splice(stored, states, columns):
        told.append(sorted(r.id for r in states.collect()))
        return plain(stored, states, columns)

    monkeypatch.setattr(merge, "scd2_splice", splice)
    tables.create_dimension(spark, "t.few", DDL, buckets=2)
    for n, batch in enumerate([[(1, "a"), (2, "b")], [(2, "c"), (3, "d")]]):
        tables.apply_scd2(spark.createDataFrame(batch, "id long, v string").withColumn("hash", row_hash("v")), "t.few", day(n))
    assert told == [[], [2]]
    got = sorted((r.id, r.v, r.valid_from, r.valid_to) for r in spark.table("t.few").filter("valid_to IS NULL").collect())
    assert got == [(1, "a", day(0), None), (2, "c", day(1), None), (3, "d", day(1), None)]
    assert [(r.id, r.v, r.valid_to) for r in spark.table("t.few").filter("valid_to IS NOT NULL").collect()] == [(2, "b", day(1))]


def test_a_splice_moves_its_rows_once(spark):
    rows = spark.createDataFrame([(1, "a", "h", day(0), None)], "id bigint, v string, hash string, valid_from timestamp, valid_to timestamp")
    spliced = merge.scd2_splice(rows, rows.drop("valid_to"), rows.columns)
    assert spliced._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [(r.id, r.v) for r in spliced.collect()] == [(1, "a")]


def test_ids_of_a_batch_are_not_gathered_on_the_driver(spark, schema, monkeypatch):
    """Whatever size Spark takes them for, and where ids are known before, in the log of the time, and open; and nothing absent is staged."""
    staged, plain = [], tables.stage

    def stage(df, name):
        staged.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df, name)

    monkeypatch.setattr(tables, "stage", stage)
    tables.create_dimension(spark, "t.d", DDL, buckets=2)
    tables.apply_scd2(states(spark, {1: "a", 2: "x"}), "t.d", day(0))
    assert [name for name, _ in staged] == ["d"]
    for n, told in ((3, {1: "b", 3: "x"}), (3, {4: "y"}), (1, {1: "c", 2: "x"})):
        tables.apply_scd2(states(spark, told), "t.d", day(n))
    assert {"d-told", "d-stored", "d-changes"} <= {name for name, _ in staged}
    assert not [name for name, plan in staged if "BroadcastExchange" in plan]
    assert history(spark) == folded({day(0): {1: "a", 2: "x"}, day(1): {1: "c", 2: "x"}, day(3): {1: "b", 3: "x", 4: "y"}})


def test_new_partitions_come_in_one_statement(spark, schema, monkeypatch):
    tables._keyed(spark, "t.listing", schemas.LISTING, "parquet", 8)
    said, plain = [], type(spark).sql

    def sql(self, text, *x, **y):
        said.append(text)
        return plain(self, text, *x, **y)

    monkeypatch.setattr(type(spark), "sql", sql)
    tables.upsert_table(listing(spark, range(200)), "t.listing", ["id"])
    assert len([x for x in said if x.startswith("ALTER")]) == 1
    tables.upsert_table(listing(spark, range(300)), "t.listing", ["id"])
    assert tables.rows(spark, "t.listing").count() == 300
    with pytest.raises(ValueError, match="more than once"):
        tables.upsert_table(listing(spark, [1, 2, 2]), "t.listing", ["id"])


def test_a_batch_is_written_once(spark, schema, tmp_path, monkeypatch):
    """What the ingest stores as the batch is what the upsert and the dimensions read."""
    staged, plain = [], tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, name: (staged.append(name), plain(df, name))[1])
    tables.create_silver(spark, "s", buckets=2)
    ads(tmp_path / "cell", f"{day(0):%d-%m-%Y}-daily-cell.json", {1: 1.0, 2: 2.0})
    assert jobs.ingest_report(spark, str(tmp_path / "cell"), "cell", day(0), schema="s").first().rows_stored == 2
    columns, listed = jobs._batch(spark, "s.cell_listings", None)
    assert columns.count() == listed.count() == 2 and not {"raw-batch", "batch-columns"} & set(staged)


def test_the_landings_of_a_gold_job_share_their_ads(spark, tmp_path, monkeypatch):
    from mercato.checks import job_queries, views

    made, landed = [], []
    rows = [(k, k, 5.0, START.date(), "red bolt", "Brand#1", "T", 8, "C", "N", "R", r) for k in (1, 10) for r in range(1 + (k == 10))]
    frame = spark.createDataFrame(rows, "k long, ck long, total double, day date, p_name string, p_brand string, p_type string, p_size int, "
                                        "c_name string, n_name string, r_name string, r int")  # fmt: skip
    monkeypatch.setattr(views, "ads", lambda *x, **y: made.append(y) or frame)
    monkeypatch.setattr(job_queries, "_land", lambda spark, folder, category, run, lines: landed.append((category, lines.count())))
    for place in ("ingest", "update_gold", "update_dictionaries"):
        monkeypatch.setattr(job_queries.jobs, place, lambda *x, **y: None)
    for name in ("raw_brands", "raw_models"):
        monkeypatch.setattr(views, name, lambda *x: None)
    monkeypatch.setattr(job_queries, "_GOLD", {})
    job_queries.gold(spark, str(tmp_path))
    assert landed == [("cell", 2), ("cell", 1), ("motorcycle", 2), ("motorcycle", 1)] and len(made) == 1
