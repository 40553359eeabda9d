"""Context mixing against plain loops: counts of beginnings, the bits of a word, and texts word by word."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from mercato.llm import mixer
from mercato.llm.text import mixed


def test_beginnings_are_counted_exactly():
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abcd\xc3\xa9") for _ in range(rng.randrange(1, 9))) for _ in range(300)} | {b"x" * 300, b"x" * 299 + b"y", b"a"}, key=mixer.coded)
    times = np.array([rng.randrange(0, 5) for _ in words], float)
    seen, went = mixer.beginnings([mixer.coded(w) for w in words], times)
    bits = lambda w: "".join(f"{c:08b}" for c in mixer.coded(w))
    count = Counter()
    for w, n in zip(words, times):
        b = bits(w)
        for k in range(len(b) + 1):
            count[b[:k]] += n
    at = 0
    for w in words:
        b = bits(w)
        for k in range(len(b)):
            early = k // 8 < mixer.PREFIX
            assert (seen[at + k], went[at + k]) == ((0, 0) if early else (count[b[:k]], count[b[: k + 1]])), (w, k)
        at += len(b)
    assert at == len(seen)


def model(words, times):
    """A model with the counts of some words, and weights that differ by gate."""
    rng = np.random.default_rng(3)
    m = mixer.Model(np.zeros((2, mixer.TABLE), np.float32), rng.uniform(0.1, 0.5, (mixer.GATES, mixer.INPUTS)), rng.uniform(0.2, 0.8, (mixer.GATES, mixer.BINS)))
    b = mixer.bits_of(words)
    w = np.array(times, float)[b.word]
    for slots in b.slots:
        np.add.at(m.counts[0], slots[b.bit == 0], w[b.bit == 0])
        np.add.at(m.counts[1], slots[b.bit == 1], w[b.bit == 1])
    return m


def plain_word(m, words, times, word):
    """log10 of a word, bit by bit."""
    total, data = 0.0, mixer.coded(word)
    known = Counter()
    for w, n in zip(words, times):
        b = "".join(f"{c:08b}" for c in mixer.coded(w))
        for k in range(len(b) + 1):
            known[b[:k]] += n
    for place, byte in enumerate(data):
        for b in range(8):
            bit = byte >> (7 - b) & 1
            partial = (1 << b) | (byte >> (8 - b))
            zeros, ones = [], []
            for j, (order, size) in enumerate(mixer.ORDERS):
                context = 0
                for k in range(1, order + 1):
                    context |= (data[place - k] + 1 if place >= k else 0) << (9 * (k - 1))
                key = mixed(np.array([context], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(order)) + np.uint64(partial * 0xD6E8FEB86659FD93 % 2**64)
                key = int(key[0])
                slot = mixer.PLACES[j] + ((key ^ (key >> 29)) * 0xBF58476D1CE4E5B9 % 2**64 >> (64 - size))
                zeros.append(float(m.counts[0][slot]))
                ones.append(float(m.counts[1][slot]))
            so_far = "".join(f"{c:08b}" for c in data[:place]) + f"{byte:08b}"[:b]
            exact = place >= mixer.PREFIX
            zeros.append(known[so_far + "0"] if exact else 0)
            ones.append(known[so_far + "1"] if exact else 0)
            top = max([k + 1 for k in range(len(zeros)) if zeros[k] + ones[k] > 0], default=0)
            n = zeros[max(top - 1, 0)] + ones[max(top - 1, 0)]
            gate = (top * 4 + sum(n >= x for x in (3, 20, 300))) * 8 + b
            odds = [math.log((x + mixer.FEW) / (z + mixer.FEW)) for z, x in zip(zeros, ones)] + [0.3]
            z = max(-12, min(12, sum(o * w for o, w in zip(odds, m.weights[gate]))))
            p = (1 / (1 + math.exp(-z)) + m.refined[gate, round((z + 12) * (mixer.BINS - 1) / 24)]) / 2
            p = max(1e-6, min(1 - 1e-6, p))
            total += math.log10(p if bit else 1 - p)
    return total


def test_bits_of_a_word_one_by_one():
    words = sorted([b"the", b"then", b"there", b"thereby", b"zebra", "é".encode() * 3], key=mixer.coded)
    times = [9.0, 3.0, 4.0, 1.0, 2.0, 5.0]
    m = model(words, times)
    for part in mixer.parts(words, np.array(times), 4):
        for w, got in zip(part[0], m.log10(part[0], part[2], part[3])):
            assert got == pytest.approx(plain_word(m, words, times, w), rel=1e-4)
    asked = sorted([*words, b"theory"], key=mixer.coded)
    counts = [times[words.index(w)] if w in words else 0.0 for w in asked]
    seen, went = mixer.beginnings([mixer.coded(w) for w in asked], np.array(counts))
    assert dict(zip(asked, m.log10(asked, seen, went)))[b"theory"] == pytest.approx(plain_word(m, words, times, b"theory"), rel=1e-4)


def plain_text(had, text, value, end):
    """log10 of a text, word by word."""
    total, count, before, last, taken = 0.0, Counter(), 0, 0, 0.0
    for t, w in enumerate([*text, None]):
        yes = 0.0
        if t:
            cells = [min(int(math.log2(t + 1)), mixer.PLACE_STEPS - 1) * 8 + last, mixer.PLACE_STEPS * 8 + (mixer.crc32(text[t - 1]) & (mixer.BEFORE - 1) if w is not None else 0)]
            odds = [math.log((before + 0.5) / (t - before + 0.5))] + [math.log((had.counts[1][c] + 0.5) / (had.counts[0][c] + 0.5)) for c in cells] + [0.3]
            yes = 1 / (1 + math.exp(-max(-12, min(12, sum(o * x for o, x in zip(odds, had.weights[cells[0] // 8]))))))
        if w is not None and count[w]:
            total += math.log10(yes * count[w] / t)
        else:
            total += math.log10(1 - yes) + (end if w is None else value[w]) - math.log10(max(1 - taken, 0.02))
            taken += 0 if w is None else 10 ** value[w]
        if w is not None:
            seen = count[w] > 0
            before, last, count[w] = before + seen, (last << 1 | seen) & 7, count[w] + 1
    return total


def test_texts_word_by_word(spark):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (0, 1, 2, 3, 10, 300)] + ["a a a a", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    words = mixer.block_words(batch, 3)
    r = mixer.repeats(words)
    had = mixer.Had(rng.integers(0, 9, (2, mixer.HAD_CELLS)).astype(float), rng.uniform(0.1, 0.5, (mixer.PLACE_STEPS, mixer.HAD_INPUTS)))
    value = {w: -1.5 - rng.random() for w in words.distinct}
    got = had.log10(r, words, np.array([value[w] for w in words.distinct]), -2.0)
    for k, text in enumerate(texts):
        assert got[k] == pytest.approx(plain_text(had, (text or "").encode().split(), value, -2.0), rel=1e-9)


def test_what_repeats_costs_less_and_order_counts(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("rin", "tas", "vel") for c in ("o", "um", "ia", "es")]
    rows = [(k, " ".join(rng.choice(vocabulary, 30))) for k in range(200)]
    rows += [(1000, "unseen " * 20), (1001, " ".join(f"unseen{k}" for k in range(20)))]
    held = [k for k, _ in rows if mixer.crc32(str(k).encode()) % 5 == 1]
    got = {r.doc_id: r for r in mixer.score(spark.createDataFrame(rows, "doc_id long, text string"), 2_000).collect()}
    assert got[1000].score > got[1001].score + 20
    assert sum(got[k].score for k in held) / sum(got[k].n_tokens for k in held) > -2
    assert got[held[0]].bits_per_byte == pytest.approx(-got[held[0]].score * math.log2(10) / len(dict(rows)[held[0]]))


def test_words_of_a_block_are_numbered_once():
    import pyarrow as pa

    texts = [None, "", " ", "\n", "a  B a\tb\x0b\x0c", " Ä x\x1cy \x85 y ÄA\xa0z", "x" * 20 + " xxxxy xxxx", "b"]
    block = pa.RecordBatch.from_pydict({"doc_id": pa.array([*range(7), None], pa.int64()), "held_out": [k % 2 == 0 for k in range(8)], "text": texts}).slice(1)
    words = mixer.block_words(block, 3)
    plain = [(x or "").encode().lower().split() for x in texts[1:]]
    assert [words.distinct[k] for k in words.at] == [w for x in plain for w in x] and words.size.tolist() == [len(x) for x in plain]
    assert len(set(words.distinct)) == len(words.distinct) and sorted(words.bucket.tolist()) == words.bucket.tolist()
    assert words.bucket.tolist() == [mixer.crc32(mixer.coded(w)[: mixer.PREFIX]) & 7 for w in words.distinct]
    rows, n_bytes, again = mixer.Words.unpacked(words.packed(block))
    assert rows["doc_id"].to_pylist() == block["doc_id"].to_pylist() and n_bytes.tolist() == [len((x or "").encode()) for x in texts[1:]]
    for x, y in zip(vars(mixer.repeats(words)).values(), vars(mixer.repeats(again)).values()):
        assert np.array_equal(x, y)


def test_mixer_reads_texts_once(spark, monkeypatch):
    """Texts are cut into words when blocks ask, and not again for their scores."""
    docs = spark.createDataFrame([(k, f"a b c{k % 7} a") for k in range(40)], "doc_id long, text string")
    plan = mixer.score(docs, 200)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan and "body" in plan
