import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mercato.operators import merge, quality

START = datetime(2026, 1, 1)
DDL = "id bigint, v string, hash string, valid_from timestamp, valid_to timestamp"


def day(n):
    return START + timedelta(days=n)


def batch(spark, states):
    return spark.createDataFrame([(k, v, f"h{v}") for k, v in states.items()], "id bigint, v string, hash string")


def empty(spark):
    return spark.createDataFrame([], DDL)


def fold(spark, batches):
    table = empty(spark)
    for n, states in enumerate(batches):
        after = merge.scd2_apply(table, batch(spark, states), day(n))
        table = spark.createDataFrame(after.collect(), DDL)
    return table


def two_pass(batches):
    """Close changed current rows, then insert keys without a current row."""
    table = []
    for n, states in enumerate(batches):
        for row in table:
            if row["to"] is None and row["id"] in states and states[row["id"]] != row["v"]:
                row["to"] = day(n)
        current = {r["id"] for r in table if r["to"] is None}
        table += [{"id": k, "v": v, "from": day(n), "to": None} for k, v in states.items() if k not in current]
    return sorted((r["id"], r["from"], r["to"], r["v"]) for r in table)


def versions(df):
    return sorted((r.id, r.valid_from, r.valid_to, r.v) for r in df.collect())


def key(r):
    return (r[0], r[1])


def random_batches(seed):
    rng = random.Random(seed)
    return [{k: rng.choice("ab") for k in rng.sample(range(8), rng.randint(0, 8))} for _ in range(5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_equals_two_passes(spark, seed):
    batches = random_batches(seed)
    got = fold(spark, batches)
    assert sorted(versions(got), key=key) == sorted(two_pass(batches), key=key)
    current = got.filter("valid_to IS NULL")
    assert quality.duplicate_keys(current, ["id"]).count() == 0
    assert quality.check_violations(got, {"interval": "valid_to IS NULL OR valid_to > valid_from"}).first()[0] == 0


def test_scd2_cases(spark):
    got = versions(fold(spark, [{1: "a", 2: "x"}, {1: "b"}, {1: "a", 3: "n"}, {}]))
    assert got == [
        (1, day(0), day(1), "a"),
        (1, day(1), day(2), "b"),
        (1, day(2), None, "a"),
        (2, day(0), None, "x"),
        (3, day(2), None, "n"),
    ]


def test_scd2_replay_changes_nothing(spark):
    once = fold(spark, [{1: "a", 2: "x"}, {1: "b"}])
    again = merge.scd2_apply(once, batch(spark, {1: "b"}), day(5))
    assert versions(again) == versions(once)


def test_history_equals_fold(spark):
    batches = random_batches(7)
    states = spark.createDataFrame(
        [(k, day(n), v, f"h{v}") for n, b in enumerate(batches) for k, v in b.items()],
        "id bigint, batch timestamp, v string, hash string",
    )
    got = merge.scd2_history(states, "id", "batch")
    assert sorted(versions(got), key=key) == sorted(versions(fold(spark, batches)), key=key)


def test_small_batch_does_not_move_the_current_versions(spark, tmp_path):
    table = fold(spark, [{k: "a" for k in range(50)}])
    table.write.parquet(str(tmp_path / "open"))
    batch(spark, {1: "b"}).write.parquet(str(tmp_path / "batch"))
    current, new = spark.read.parquet(str(tmp_path / "open")), spark.read.parquet(str(tmp_path / "batch"))
    plan = merge.scd2_step(current, new, day(1))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3


def test_close_missing(spark):
    table = fold(spark, [{1: "a", 2: "x"}])
    got = versions(merge.close_missing(table, batch(spark, {1: "a"}), day(3)))
    assert got == [(1, day(0), None, "a"), (2, day(0), day(3), "x")]


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    new = spark.createDataFrame([("B", 2), ("C", 3)], "v string, id bigint")
    once = merge.upsert(target, new, ["id"])
    assert rows(once, "id") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(merge.upsert(once, new, ["id"]), "id") == rows(once, "id")
    assert rows(merge.upsert(target, new.limit(0), ["id"]), "id") == rows(target, "id")


def test_latest_batch(spark, rows):
    df = spark.createDataFrame([(1, day(0)), (2, day(1)), (3, day(1)), (4, None)], "id int, t timestamp")
    assert rows(merge.latest_batch(df, "t").select("id"), "id") == [(2,), (3,)]
    assert merge.latest_batch(df.limit(0), "t").count() == 0


def test_quality(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, "y")], "id int, v string")
    assert quality.duplicate_keys(df, ["id"]).collect() == [(1, 2)]
    assert tuple(quality.null_counts(df, ["id", "v"]).first()) == (0, 1)
    assert tuple(quality.check_violations(df, {"v_is_x": "v = 'x'"}).first()) == (1,)  # NULL passes
    assert quality.profile(df, ["id", "v"]).collect() == [("id", 3, 0, "1", "2", 1.3333, 0.5774), ("v", 2, 1, "x", "y", None, None)]


def test_keep_first_and_ties(spark, rows):
    from mercato.operators.dedup import keep_first, with_ties

    df = spark.createDataFrame([("k", i % 3, i) for i in range(1000)] + [("j", 5, 0)], "k string, a int, b int")
    assert rows(keep_first(df, ["k"], [F.col("a").desc(), "b"]), "k") == [("j", 5, 0), ("k", 2, 2)]
    assert with_ties(df, ["k"], "a").count() == 334 + 1
