"""Fingerprints against a plain count, and pairs of neighbours against a sorted list."""

import random
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from mercato.llm import fingerprints as fp

SCHEMA = "doc_id long, text string"


def plain(text):
    """Length and classes by counting runs of three bytes one by one."""
    data = b"\0\0" + text.encode() + b"\0\0"
    hits = Counter(int.from_bytes(data[k : k + 3], "big") * 2654435761 % 2**32 >> 22 for k in range(len(data) - 2))
    counts = [hits[k] for k in range(fp.BUCKETS)]
    q = sorted(counts)
    return [sum(c > q[n * fp.BUCKETS // 4 - 1] for n in (1, 2, 3)) for c in counts]


def edit(a, b):
    return a[: len(a) - len(a) // 2] + b[: len(a) // 2]


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "é🙂", "x" * 5000, "the quick brown fox " * 30, "\x00\x00", "".join(map(chr, range(32, 2000)))])
def test_classes(text):
    length, own = fp.classes(text.encode())
    assert own.tolist() == plain(text)
    back = fp.read(fp.written(length, own))
    assert back[0] == length and back[1].tolist() == own.tolist()
    assert fp.likeness(fp.written(length, own), fp.written(length, own)) == 1


def test_bounds_of_likeness():
    a, b = "00" + "00" * 256, "ff" + "ff" * 256
    assert fp.likeness(a, b) == 0 and fp.likeness(a, a) == 1


@pytest.mark.parametrize("per_bucket", [1, 3, 500])
def test_neighbours(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(fp, "ROWS_PER_BUCKET", per_bucket)
    monkeypatch.setattr(fp, "DRAWS", 2)
    rng = random.Random(5)
    rows = [(k * 7 - 100, " ".join(rng.choices(["alpha", "beta", "gamma", "déjà", "🙂"], k=rng.randrange(0, 60)))) for k in range(40)]
    rows += [(10**15, None), (10**15 + 1, ""), (10**15 + 2, "long " * 20000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fingerprint", F.lit("mine")).withColumn("bucket", F.lit("mine")).repartition(7)
    got = {r.doc_id: r for r in fp.neighbours(docs).collect()}
    rows = sorted((i, x or "") for i, x in rows)
    assert len(got) == len(rows)
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        r, edited = got[i], edit(a, b)
        assert (r.n_chars, r.edited_sha256) == (len(a), sha256(edited.encode()).hexdigest())
        names = [fp.written(*fp.classes(x.encode())) for x in (a, edited, b)]
        assert (r.fingerprint, r.edited_fingerprint) == tuple(names[:2])
        assert r.near_edited == fp.likeness(*names[:2]) and r.near_next == fp.likeness(names[0], names[2])


@pytest.mark.parametrize("per_bucket", [1, 500])
def test_ties_nulls_and_repeated_rows(spark, monkeypatch, per_bucket):
    """A third of the rows without id, another with one id: each row once, in one chain."""
    monkeypatch.setattr(fp, "ROWS_PER_BUCKET", per_bucket)
    monkeypatch.setattr(fp, "DRAWS", 1)
    rows = [(None, f"none {k}") for k in range(10)] + [(5, f"same {k}") for k in range(10)] + [(6, "equal")] * 5 + [(7, "last"), (-1, "first")]
    got = fp.neighbours(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    ids = [None] * 10 + [-1] + [5] * 10 + [6] * 5 + [7]
    after = {-1: "same", 7: "none"}
    for r in got:
        if r.doc_id in after:
            own = "first" if r.doc_id == -1 else "last"
            assert any(r.edited_sha256 == sha256(edit(own, f"{after[r.doc_id]} {k}").encode()).hexdigest() for k in range(10))
    equal = [r.edited_sha256 for r in got if r.doc_id == 6]
    assert sorted(equal) == sorted([sha256(b"equal"[:3] + b"eq").hexdigest()] * 4 + [sha256(b"equla").hexdigest()])
    assert len(ids) == len(got)


def test_few_rows(spark):
    assert fp.neighbours(spark.createDataFrame([], SCHEMA)).count() == 0
    (r,) = fp.neighbours(spark.createDataFrame([(1, "abcdef")], SCHEMA)).collect()
    assert r.near_next == 1 and r.edited_sha256 == sha256(b"abcabc").hexdigest()


def test_columns_stay(spark, odd):
    got = fp.fingerprints(odd)
    assert got.columns == [*odd.columns, "fingerprint"] and got.count() == odd.count()
    assert fp.fingerprints(got).columns == got.columns
    texts = {r.text: r.fingerprint for r in got.collect()}
    assert texts[None] == texts[""]
