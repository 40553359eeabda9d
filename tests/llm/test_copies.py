"""Operators on repeated texts, vectors, payloads and transcripts against plain versions."""

import random
from collections import defaultdict

import numpy as np
import pytest
import zstandard
from pyarrow import fs

from mercato.llm import anchors, chat, covertree, jaccard, links, warc


def _classes(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = dict(links.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    pairs = [(a, b) for a, b in pairs if a != b]
    assert got == _classes(pairs, {x for p in pairs for x in p})
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _texts():
    rng = random.Random(9)
    vocabulary = [f"v{k}" for k in range(500)]
    shared = [rng.choice(vocabulary) for _ in range(45)]
    out = {}
    for k in range(30):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([5, 25, 120, 200]))]
        if k % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = shared
        out[k] = words
    for k in range(30, 50):  # copies, some with a few words changed
        words = list(out[k % 7 + 2])
        for _ in range(k % 3):
            words[rng.randrange(len(words))] = "changed"
        out[k] = words
    return out


def _removed(texts):
    seen, gone = set(), defaultdict(set)
    for k in sorted(texts):
        for p in range(len(texts[k]) - 19):
            w = tuple(texts[k][p : p + 20])
            if w in seen:
                gone[k].update(range(p, p + 20))
            seen.add(w)
    return {k: " ".join(w for p, w in enumerate(x) if p not in gone[k]) for k, x in texts.items()}


@pytest.mark.parametrize("block_bytes", [700, 10**7])
def test_substring_dedup(spark, block_bytes):
    texts = _texts()
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in texts.items()], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.kept_text for r in anchors.dedup(df, block_bytes).collect()}
    assert got == _removed(texts)


def test_cover_has_every_difference():
    differences = {(a - b) % anchors.PERIOD for a in anchors.COVER for b in anchors.COVER}
    assert differences == set(range(anchors.PERIOD)) and anchors.PERIOD - 1 + anchors.ANCHOR == anchors.WIDTH


def test_substring_dedup_on_odd_rows(odd):
    got = {(r.doc_id, r.n_words): r for r in anchors.dedup(odd).collect()}
    assert anchors.dedup(odd).count() == odd.count() and anchors.dedup(odd.limit(0)).count() == 0
    assert got[(2, 0)].kept_text == "" and got[(1, 3)].kept_text == "a b c"
    assert got[(5, 3000)].n_removed == 2999  # all windows but the first start earlier too
    assert got[(10, 61)].kept_text == "up"


def _sets(texts):
    grams = lambda w: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    return {k: grams(x) for k, x in texts.items()}


def test_jaccard_classes(spark):
    texts = _texts()
    rng = random.Random(2)
    for k in range(100, 140):  # a chain of near copies
        texts[k] = list(texts[k - 1]) if k > 100 else [f"c{j}" for j in range(150)]
        texts[k][rng.randrange(150)] = f"n{k}"
    sets = _sets(texts)
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    df = spark.createDataFrame([(k, " ".join(x).upper()) for k, x in texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    want = _classes(pairs, texts)
    assert got == {k: (len(sets[k]), want[k]) for k in texts}
    assert len(set(want.values())) < len(texts) - 20


def test_jaccard_on_odd_rows(odd):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(odd).collect()]
    assert len(got) == odd.count()
    assert {(1, 1, 1), (6, 1, 1), (2, 0, 2), (4, 0, 4), (None, 2, None), (10, 59, 9)} <= set(got)
    assert jaccard.join(odd.limit(0)).count() == 0


def _vectors():
    rng = np.random.default_rng(4)
    rows, base = [], rng.normal(size=(12, 16))
    for k in range(300):
        x = base[k % 12] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.3, 2.0])
        rows.append((k, [float(v) for v in np.float32(x)], k % 2))
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [1.0, None] * 8, 1), (303, [float("nan")] * 16, 1), (304, rows[0][1], None), (305, rows[0][1], 0)]
    return rows


def test_vectors_against_all_pairs(spark, monkeypatch):
    rows = _vectors()
    good = [(k, np.array(x, float), y) for k, x, y in rows if y is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    pairs = [
        (a, b) for i, (a, x, p) in enumerate(good) for b, y, q in good[i + 1 :] if p == q and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93
    ]
    count = defaultdict(int)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    want = _classes(pairs, [r[0] for r in rows])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(covertree, "PART", 40)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_duplicates(df).collect()}
    assert got == {k: (count[k], want[k], want[k] == k) for k, *_ in rows}
    assert covertree.near_duplicates(df.limit(0)).count() == 0


def test_tree_covers_its_points():
    rng = np.random.default_rng(0)
    x = np.concatenate([c + rng.normal(size=(60, 8)) * 0.05 for c in rng.normal(size=(10, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)

    def check(n):
        assert (np.linalg.norm(x[n.rows] - x[n.centre], axis=1) <= n.radius + 1e-6).all()
        assert not n.kids or sorted(np.concatenate([k.rows for k in n.kids])) == sorted(n.rows)
        return 1 + sum(map(check, n.kids))

    assert check(covertree.tree(x)) > 10


def test_bundles_are_seekable(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    rows = [(k, f"http://x/{k}", ("é" * 300 + str(k % 5)) if k % 2 else f"s{k % 3}") for k in range(40)] + [(40, None, None), (None, "u", "é" * 300 + "1")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    folder = str(tmp_path / "w")
    index = warc.write(df, folder)
    got = {r.page_id: r for r in warc.read_back(index, folder).collect()}
    assert len(got) == len(rows) and warc.write(df.limit(0), folder).count() == 0
    first = {}
    for k, _, html in rows[:40]:
        if html and len(html.encode()) >= 100:
            first.setdefault(html, k)
    for k, _, html in rows[:40]:
        again = first.get(html, k) != k
        assert (got[k].record_type, got[k].refers_to, got[k].payload_bytes) == (
            "revisit" if again else "response", first[html] if again else None, len(html.encode()),
        )
    assert got[40].payload_bytes == 0 and got[None].refers_to == 1
    # by the seek table alone, and as one stream
    store, root = fs.FileSystem.from_uri(folder)
    name = index.first().bundle
    with store.open_input_file(f"{root}/{name}") as file:
        table = warc.read_seek_table(file)
        frames = [zstandard.ZstdDecompressor().decompress(file.read_at(n, start)) for start, n, _ in table]
    assert len(table) > 1 and [len(x) for x in frames] == [plain for _, _, plain in table]
    with open(f"{root}/{name}", "rb") as file:
        whole = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert whole == b"".join(frames) and whole.startswith(b"WARC/1.1\r\n")


def _conversations(spark, n=60):
    rng = random.Random(6)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 7)):
            role = "user" if t % 2 == 0 else "assistant"
            text = "\n".join(" ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randrange(1, 9))) + ("?" if role == "user" else ".") for _ in range(rng.randrange(1, 3)))
            rows.append((c, t, role, text))
    rows += [(None, 0, "user", "hello?"), (1000, None, None, None), (1001, 0, "wizard", "")]
    rows += [(5000, t, "user" if t % 2 == 0 else "assistant", "long one?" if t % 2 == 0 else "yes.") for t in range(300)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_roles_in_blocks(spark, monkeypatch):
    df = chat.transcripts(_conversations(spark))
    model = chat.learned(chat.ordered(df))
    whole = sorted(map(str, chat.recover(df, model).collect()))
    held = chat.recover(df, model).filter("conv_id < 1000")
    assert held.filter("found_role = role").count() >= 0.9 * held.count()
    monkeypatch.setattr(chat, "BLOCK_ROWS", 7)
    assert sorted(map(str, chat.recover(df, model).collect())) == whole and len(whole) == df.count()
    assert chat.recover(df.limit(0)).count() == 0


def test_blockwise_scores_are_viterbi():
    rng = np.random.default_rng(8)
    model = chat.Model({})
    model.start, model.move = np.log(rng.dirichlet(np.ones(chat.STATES))), np.log(rng.dirichlet(np.ones(chat.STATES), chat.STATES))
    e = np.log(rng.random((12, chat.STATES)))
    path = model.path(e, None, None)
    best = model.start[path[0]] + e[0, path[0]] + sum(model.move[a, b] + e[k + 1, b] for k, (a, b) in enumerate(zip(path, path[1:])))
    chained = model.through(e[:5], True)[0][:, None] + model.through(e[5:], False)
    assert chained.max() == pytest.approx(best)


def test_jaccard_makes_a_pair_of_many_lists_once(spark, monkeypatch):
    """Four nodes in 60 lists, two of one component; one list is the hub's own. Without a look at earlier lists there would be a row per list and pair."""
    lists = {1: range(60), 2: range(60), 3: range(0, 60, 2), 4: range(1, 60, 3), 5: [7]}
    part = {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    rows = [(t, d, part[d], 1 if t % 2 else 3, 100, [0, 0, 0, 0]) for d, own in lists.items() for t in own]
    some = spark.createDataFrame(rows, "t long, d long, c long, main long, n long, odd array<long>")
    wanted = {(a, b) for a in lists for b in lists if a < b and part[a] != part[b] and set(lists[a]) & set(lists[b])}
    got = [tuple(r) for r in jaccard.apart_pairs(jaccard.with_earlier(some)).collect()]
    assert set(got) == wanted and len(got) <= 2 * len(wanted)
    monkeypatch.setattr(jaccard, "EARLIER", 1)
    assert {tuple(r) for r in jaccard.apart_pairs(jaccard.with_earlier(some.union(some))).collect()} == wanted
