"""Operators on single texts against plain versions, and on odd rows."""

import pickle
import struct
from hashlib import sha256
from math import comb, log10
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import bpe, mixer, mixing, quality, toxicity
from mercato.llm.queries import tokenizer


def test_quality_counts():
    text = "One two three\n\none two three one two three\nOne two three\n#a $b\xa0c\x1cd".encode()
    words = text.split()
    n_words, chars, symbols, dup, repeated, lines, *_ = quality.measure(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    twice = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    assert (n_words, chars, symbols, dup, repeated, lines) == (len(words), sum(len(w.decode()) for w in words), 2, 1, len(twice), 4)
    assert quality.measure(b"")[:5] == (0, 0, 0, 0, 0)


@given(st.integers(1, 60), st.floats(0.01, 0.6), st.data())
@settings(max_examples=60, deadline=None)
def test_binomial_is_exact(n, p, data):
    k = data.draw(st.integers(0, n))
    assert quality.binomial_cdf(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel=1e-9)


def test_cutoffs_stop_where_the_bound_does():
    assert quality.choose(np.array([0, 0, 3, 90]), 1000, 0.01, 0.05) == 3
    assert quality.choose(np.array([0, 0]), 20, 0.01, 0.05) == 0  # too few texts show nothing


def test_quality_on_odd_rows(spark, odd, labels):
    got = {(r.doc_id, r.n_words): r for r in quality.judge(odd, labels).collect()}
    assert quality.judge(odd, labels).count() == odd.count()
    assert got[(2, 0)].base_failed and not got[(2, 0)].kept and got[(5, 3000)].base_failed
    assert got[(9, 60)].kept and got[(9, 60)].reasons == []
    assert quality.judge(odd.limit(0), labels.limit(0)).count() == 0


def test_quality_cutoffs_of_small_strata(spark):
    from pyspark.sql import functions as F

    # 200 good texts of de, 40 of fr; xx has 24 good texts full of symbols, yy too few to say anything
    sizes = {"en": 2000, "de": 200, "fr": 40, "xx": 24, "yy": 3}
    rows = [(lang, k, 2.0 if lang == "xx" else 0.0) for lang, n in sizes.items() for k in range(n)]
    good = spark.createDataFrame(rows, "stratum string, k int, symbols_per_word double").withColumn("doc_id", F.monotonically_increasing_id())
    good = good.withColumns({r: F.col("k") % 7 * 0.001 for r in quality.RULES if r != "symbols_per_word"})
    got = {r.stratum: r for r in quality.cutoffs(good).collect()}
    assert set(got) == {"en", "de", "fr"} and [got[x].pooled for x in ("en", "de", "fr")] == [False, False, True]
    assert got["en"].symbols_per_word < 0.02 and got["de"].symbols_per_word < 0.02 and got["fr"].symbols_per_word is not None


def test_quality_bounds_all_rules_together(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    values = rng.exponential(0.1, (4000, len(quality.RULES)))
    good = spark.createDataFrame([(k, *map(float, x)) for k, x in enumerate(values)], ["doc_id", *quality.RULES])
    cut = quality.cutoffs(good.withColumn("stratum", F.lit("en"))).first()
    most = np.array([np.inf if cut[r] is None else cut[r] for r in quality.RULES])
    lost = (rng.exponential(0.1, (40_000, len(quality.RULES))) > most).any(1).mean()
    assert 0.02 < lost <= quality.RISK


def test_tokens_equal_tiktoken(spark, odd):
    import public_tokenizers

    t = tokenizer()
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(3)
    texts = [r.text for r in odd.collect()] + [
        "".join(map(chr, rng.choice([9, 10, 32, 39, 65, 100, 108, 160, 0x1C, 0x85, 0x2028, 0x3042, 0x1F642, 0x301, 0xBD, 0x660], 80))) for _ in range(40)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert bpe.encoded(df.limit(0), t).count() == 0
    got = {r.doc_id: r for r in bpe.encoded(df, t).collect()}
    for k, text in enumerate(texts):
        ids = plain.encode_ordinary(text or "")
        assert got[k].ids == struct.pack(f"<{len(ids)}I", *ids)
        assert got[k].decoded == (text or "").encode()
    one = bpe.digests(df.filter("doc_id = 0"), t).first()
    ids = plain.encode_ordinary(texts[0])
    assert (one.n_tokens, one.ids_sha256) == (len(ids), sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def test_whole_tokens_that_merges_do_not_reach():
    ranks = {bytes([c]): c for c in range(256)} | {b"ab": 256, b"xyz": 257}
    t = bpe.Tokenizer.__new__(bpe.Tokenizer)
    assert bpe._merged(b"abab", ranks) == [256, 256] and bpe._merged(b"xyz", ranks) != [257]
    del t


def test_mixing_counts(spark, odd):
    got = mixing.replicate(odd, {"s": 3, "t": 1})
    again = mixing.replicate(odd.repartition(5), {"t": 0.25, "s": 0.75})
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert got.filter("source is null").count() == 0
    many = spark.range(3000).selectExpr("id as doc_id", "if(id < 2900, 'big', 'small') source", "'x' text")
    counts = dict(mixing.replicate(many, {"big": 1, "small": 1}).groupBy("source").count().collect())
    assert abs(counts["big"] - 1500) < 150 and abs(counts["small"] - 1500) < 150
    assert mixing.replicate(odd.limit(0)).count() == 0


def test_toxicity_learns_a_pair_of_terms():
    rng = np.random.default_rng(1)
    filler = [f"w{k}" for k in range(200)]
    data = []
    for k in range(1200):
        insult, group = k % 2, k // 2 % 2
        words = list(rng.choice(filler, 20)) + ["insult"] * insult + ["group"] * group
        data.append((toxicity.slots(" ".join(words).encode()), insult & group))
    m = toxicity.learn(data, epochs=20)
    score = lambda *w: m.score(" ".join([*rng.choice(filler, 20), *w]).encode())
    assert score("insult", "group") > 0.5 > max(score("insult"), score("group"), score())
    assert m.vectors.any()


def test_toxicity_of_terms_never_seen():
    rng = np.random.default_rng(5)
    data = []
    for k in range(1200):
        words = [f"w{x}" for x in rng.integers(0, 200, 20)] + [f"insult{x}" for x in range(30) if k % 4 == 0 and rng.random() < 0.5]
        data.append((toxicity.slots(" ".join(words).encode()), int(k % 4 == 0)))
    m = toxicity.learn(data)
    clean = " ".join(f"{k:x}qz" for k in range(200_000))
    assert m.score(clean.encode()) == m.score(b"") < 0.5 < m.score(b"insult3 insult7 insult9 insult11")


def test_toxicity_learns_a_group_that_is_as_frequent_in_both_classes():
    rng = np.random.default_rng(6)
    filler = [f"w{k}" for k in range(200)]

    def text(kind):  # an insult is toxic with the group only, a slur without it only
        words = ["insult"] * (kind in (1, 2)) + ["slur"] * (kind in (3, 4)) + ["group"] * (kind % 2)
        return " ".join([*rng.choice(filler, 20), *words]).encode()

    data = [(toxicity.slots(text(k % 8)), int(k % 8 in (1, 4))) for k in range(2400)]
    group = toxicity.slots(b"group")
    assert np.mean([np.isin(group, i).all() for i, y in data if y]) == np.mean([np.isin(group, i).all() for i, y in data if not y])
    m = toxicity.learn(data, epochs=20)
    assert [int(m.score(text(k)) > 0.5) for k in range(8)] == [0, 1, 0, 0, 1, 0, 0, 0]


def test_toxicity_keeps_rare_insults():
    rng = np.random.default_rng(7)
    data = [(toxicity.slots(f"w{rng.integers(50)} w{rng.integers(50)} {'rare' if k % 9 == 0 and k < 45 else ''}".encode()), int(k % 9 == 0)) for k in range(3155)]
    assert np.isin(toxicity.slots(b"rare"), toxicity.screened(data)).all()


def test_toxicity_on_odd_rows(spark, odd, labels):
    m = toxicity.fit(odd, labels)
    got = toxicity.score(odd, m)
    assert got.count() == odd.count() and got.filter("toxicity between 0 and 1").count() == odd.count()
    assert toxicity.fit(odd.limit(0), labels).score(b"anything") < 0.5


def test_mixer_base_and_blocks(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    count, ends = {}, 0
    for r in rows:
        if r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 != 1:
            ends += 1
            for w in (r.text or "").encode().lower().split():
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()) + ends, len(count) + 1
    got = mixer.score(odd, 200).collect()
    assert len(got) == len(rows)
    want = []
    for r in rows:
        tokens = (r.text or "").encode().lower().split()
        base = sum(log10((count.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in tokens) + log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        want.append((r.doc_id, len(tokens) + 1, sum(w in count for w in tokens) + 1, n, round(base, 6)))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got)
    assert all(r.score < 0 for r in got)
    assert mixer.score(odd.limit(0)).count() == 0


def test_mixer_predicts_what_it_saw():
    words = [b"the", b"then", b"zebra"]
    b = mixer.bits_of(words * 50)
    m = mixer.Model(np.zeros((2, mixer.TABLE), np.float32), np.full((mixer.GATES, mixer.INPUTS), 0.3), np.full((mixer.GATES, mixer.BINS), 0.5))
    for slots in b.slots:
        np.add.at(m.counts[0], slots[b.bit == 0], 1)
        np.add.at(m.counts[1], slots[b.bit == 1], 1)
    m.refined = np.tile(1 / (1 + np.exp(-(np.arange(mixer.BINS) * 24 / (mixer.BINS - 1) - 12))), (mixer.GATES, 1))
    seen, unseen = m.log10([b"zebra", b"quark"])
    assert seen > -2 > unseen


def test_toxicity_screens_in_spark_as_in_memory(spark):
    """Strong terms and their partners, from counts of Spark, equal those of a plain pass; a repeated id counts once, whichever row comes first."""
    rng = np.random.default_rng(8)

    def text(kind):
        words = ["insult"] * (kind in (1, 2)) + ["slur"] * (kind in (3, 4)) + ["group"] * (kind % 2)
        return " ".join([*rng.choice([f"w{k}" for k in range(60)], 12), *words])

    rows = [(k, text(k % 8), int(k % 8 in (1, 4))) for k in range(900)]
    docs = spark.createDataFrame([(k, x) for k, x, _ in rows] + [(5, "w1 w2"), (7, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    sampled = toxicity.sample(docs, labels).collect()
    assert sorted(sampled) == sorted(toxicity.sample(docs.repartition(7), labels).collect()) and len({r.doc_id for r in sampled}) == len(sampled)
    data = [(np.array(r.ids, np.int64).view(np.uint64), r.toxic) for r in sorted(sampled)]
    got = toxicity.screened_terms(toxicity.sample(docs, labels))
    assert got.tolist() == toxicity.screened(data).tolist() and len(got) > 3
    machine, plain = toxicity.fit(docs, labels), toxicity.learn(data)
    assert np.array_equal(machine.weights, plain.weights) and np.array_equal(machine.vectors, plain.vectors)


def test_toxicity_partners_are_counted_without_their_pairs(spark, monkeypatch):
    """No row per strong term of a text, and the same terms however the rows of a term are cut into batches."""
    rng = np.random.default_rng(3)

    def text(kind):
        words = ["insult"] * (kind in (1, 2)) + ["slur"] * (kind in (3, 4)) + ["group"] * (kind % 2)
        return " ".join([*rng.choice([f"w{k}" for k in range(40)], 10), *words])

    rows = [(k, text(k % 8), int(k % 8 in (1, 4))) for k in range(600)]
    docs = spark.createDataFrame([(k, x) for k, x, _ in rows], "doc_id long, text string")
    sampled = toxicity.sample(docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")).cache()
    want = toxicity.screened([(np.array(r.ids, np.int64).view(np.uint64), r.toxic) for r in sampled.collect()]).tolist()
    exploded, explode = [], toxicity.F.explode
    monkeypatch.setattr(toxicity.F, "explode", lambda c: exploded.append(c) or explode(c))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("7", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert toxicity.screened_terms(sampled).tolist() == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert exploded == ["ids", "others"] * 2


def test_toxicity_score_is_a_plain_factorization_machine(spark):
    """Every weight and every pair of terms added up one by one."""
    rng = np.random.default_rng(9)
    words = [f"word{k}" for k in range(30)]
    terms = np.unique(np.concatenate([toxicity.slots(w.encode()) for w in words]))
    m = toxicity.Machine(-1.0, terms, rng.normal(0, 1, len(terms)).astype(np.float32), rng.normal(0, 1, (len(terms), 4)).astype(np.float32))
    texts = [None, "", "nothing known", *(" ".join(rng.choice(words, k)) for k in (1, 2, 5, 12))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, m).collect()}
    place = {t: k for k, t in enumerate(terms.tolist())}
    for k, text in enumerate(texts):
        at = [place[t] for t in toxicity.slots((text or "").encode()).tolist() if t in place]
        z = -1.0 + sum(float(m.weights[i]) for i in at)
        z += sum(float(np.dot(m.vectors[i].astype(float), m.vectors[j])) for i in at for j in at if i < j)
        assert got[k] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), rel=1e-4)


def test_long_unbroken_words(spark):
    """Pieces of thousands of letters, in which many pairs have one rank, overlap, or are rare."""
    import public_tokenizers

    t = tokenizer()
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    rng = np.random.default_rng(5)
    texts = ["x" * n for n in (63, 64, 65, 66, 200, 1001)] + ["=" * 777, " " * 500, "ab" * 300, "aab" * 300, "é" * 400, "汉字" * 300]
    texts += ["".join(rng.choice(list("etaoinsh"), n)) for n in (70, 300, 2500)] + ["".join(map(chr, rng.integers(0x4E00, 0x4F00, 600)))]
    texts += ["".join(rng.choice(["the", "ing", "ation", "q"], 400))]
    got = {r.doc_id: r for r in bpe.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), t).collect()}
    for k, text in enumerate(texts):
        ids = plain.encode_ordinary(text)
        assert got[k].ids == struct.pack(f"<{len(ids)}I", *ids), text[:20]
        assert got[k].decoded == text.encode()


def test_pieces_folded_beforehand_change_nothing(spark, odd):
    t, ranks = tokenizer(), bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rows = [(k, f"word{k % 9} andthen{k % 5} lollipop{k} d'll  \n ünd 🙂{k % 3} " + "z" * (k * 9)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    known = bpe.known_pieces(docs, t, 10)
    assert b"mercato" not in pickle.dumps(tuple(known))  # executors have no copy of the library
    places, ends = bpe.places_of(known.sizes, known.text), np.cumsum(known.lengths)
    assert len(places) == len(known.sizes) == len(known.lengths) > 5 and max(known.sizes) <= bpe.SAMPLE_BYTES
    for piece, k in places.items():
        word = piece.encode()
        assert known.values[ends[k] - known.lengths[k] : ends[k]].tolist() == ([t.whole[word]] if word in t.whole else bpe._merged(word, ranks))
    assert len(bpe.known_pieces(docs, t, 100).sizes) == 0  # few texts
    with_it = sorted(map(str, bpe.encoded(docs, t, 10).select("doc_id", "ids", "decoded").collect()))
    assert with_it == sorted(map(str, bpe.encoded(docs, t, 10**9).select("doc_id", "ids", "decoded").collect()))


def test_texts_looked_up_by_words_have_the_pieces_of_the_pattern():
    """Where pieces begin at blanks, texts are cut by blanks; all runs of white space, and words of several pieces, must come out as the pattern cuts them."""
    import public_tokenizers

    assert public_tokenizers.PATTERN == bpe.SPACED
    rng = np.random.default_rng(11)
    signs = [" ", " ", " ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u2028", "'", "s", "ll", "a", "Ä", "7", "½", "-", "🙂", "\u0301", "汉"]
    texts = [None, "", " ", "  ", " a", "a ", "a  b", "a \n b", "\n a", " \x85a", "it's 's  'll "] + ["".join(rng.choice(signs, rng.integers(1, 25))) for _ in range(3_000)]
    for pattern in (bpe.SPACED, r"\S+|\s"):
        known = ["a", " a", "  ", " '", "never"] if pattern == bpe.SPACED else ["a", "never"]
        met = bpe.Pieces(pattern, known)
        plain, names = regex.compile(pattern), list(known)
        for k in range(0, len(texts), 100):
            places, ends = met.of(texts[k : k + 100])
            names += met.new
            met.new.clear()
            assert len(names) == met.n == len(set(names))
            cuts = [0, *ends.tolist()]
            assert [[names[p] for p in places[a:z]] for a, z in zip(cuts, cuts[1:])] == [plain.findall(x or "") for x in texts[k : k + 100]]


def test_no_plan_holds_the_ranks(spark):
    """The driver keeps the texts of plans; the ranks were some MB of literals in them."""
    got = bpe.digests(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), tokenizer())
    assert len(got._jdf.queryExecution().analyzed().toJSON()) < 2_000_000
