"""The pipeline: every stage on odd rows and on nothing, and what planted documents become."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline


def test_stages_on_odd_rows(spark, odd, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd.select(*pipeline.COLUMNS, "score")
    for k, (_, step) in enumerate(pipeline.STAGES):
        assert step(spark, docs.limit(0), str(tmp_path)).count() == 0
        got = step(spark, docs, str(tmp_path))
        if k < len(pipeline.STAGES) - 1:
            assert got.columns == pipeline.COLUMNS
        got.count()


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "n-gram jaccard join", "substring dedup", "source mixing", "byte-level bpe"]


def test_copies_and_repeats_go(spark, labels, tmp_path):
    text = lambda seed, n=120: " ".join(f"{seed}{k * 7 % 101}" for k in range(n))
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, text("a")), (2, text("a")), (3, text("a").replace("a7 ", "zz ")), (4, text("b") + " " + passage), (5, text("c") + " " + passage)]
    docs = spark.createDataFrame([(k, x, "en", "s", len(x)) for k, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = pipeline.one_of_each(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == [1, 4, 5]
    cut = {r.doc_id: r.text for r in pipeline.cut_repeats(spark, left, str(tmp_path)).collect()}
    assert passage in cut[4] and cut[5] == text("c") and cut[1] == text("a")


def test_near_copies_of_five_words(spark, tmp_path):
    """Ids 1 and 2: similarity 0.81 on five words, 0.886 on three, so only the stage's own width and threshold link them. 1 and 3: 0.77 on five words."""
    base = [f"w{k}" for k in range(200)]
    near, far = list(base), list(base)
    for k in (30, 80, 130, 180):
        near[k] = f"n{k}"
    for k in (20, 60, 100, 140, 180):
        far[k] = f"f{k}"
    grams = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    alike = lambda x, n: len(grams(base, n) & grams(x, n)) / len(grams(base, n) | grams(x, n))
    assert 0.8 < alike(near, 5) < 0.83 and alike(near, 3) < 0.9 and alike(far, 5) < 0.8
    rows = [(k, " ".join(x), "en", "s", 1) for k, x in enumerate((base, near, far), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in pipeline.one_of_each(spark, docs, str(tmp_path)).collect()) == [1, 3]


def test_whole_run_equals_plain_steps(spark, tmp_path):
    """Planted toxic documents, copies, near copies and a passage: what is left of each, token by token, and how often."""
    import random
    import struct
    from hashlib import sha256

    import public_tokenizers
    import tiktoken

    from mercato.llm import bpe, mixing

    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("rin", "tas", "vel", "dor", "gun", "sem")]
    say = lambda n: [rng.choice(words) + str(rng.randrange(40)) for _ in range(n)]
    texts = {k: say(60) for k in range(200)}
    toxic = {k for k in texts if k % 5 == 0}
    for k in toxic:
        texts[k][10:10] = rng.sample(["grobian", "schuft", "lump", "halunke"], 3)
    for k in range(200, 220):  # copies
        texts[k] = list(texts[k - 199])
    for k in range(220, 230):  # near copies
        texts[k] = list(texts[k - 219])
        texts[k][30] = "changed"
    passage = [f"p{k}" for k in range(60)]
    for k in range(230, 240):
        texts[k] = say(40) + passage + say(5)
    rows = [(k, " ".join(x), "en", "s", len(" ".join(x))) for k, x in texts.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    known = [(k, 1, int(k in toxic)) for k in range(200)]
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    copied = {k: k - 199 for k in range(200, 220)} | {k: k - 219 for k in range(220, 230)}
    left = {k: x for k, x in texts.items() if k not in toxic and copied.get(k, k) not in toxic and k not in copied}
    seen = {}
    for k in sorted(left):
        own, gone = left[k], set()
        for at in range(len(own) - 19):
            if seen.setdefault(tuple(own[at : at + 20]), (k, at)) != (k, at):
                gone.update(range(at, at + 20))
        left[k] = " ".join(w for at, w in enumerate(own) if at not in gone)
    assert sum("p30" in x for x in left.values()) == 1
    times = {r.doc_id: r.n for r in mixing.replicate(spark.createDataFrame([(k, x, "en", "s", len(x)) for k, x in left.items()], schema)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for k, n in times.items():
        ids = plain.encode_ordinary(left[k])
        want += [(k, len(ids), sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), sha256(left[k].encode()).hexdigest())] * n
    assert sorted(map(tuple, pipeline.run(spark, str(tmp_path)).collect())) == sorted(want)
