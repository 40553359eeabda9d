"""Cross-tokenizer alignment against a plain walk over the two token lists."""

import json
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from mercato.llm import alignment

TEXTS = [
    (1, "the quick brown fox, doesn't  jump\n\nover 12,345 lazy dogs"), (2, "the quick brown fox"), (3, None), (4, ""), (5, " "),
    (6, "Ä ß 🙂 ▁ x"), (7, "naïve café 日本語 \t\x00 end "), (8, "<|endoftext|> <s> <0x41>"), (9, "x" * 3000), (10, "the quick brown fox"),
    (10, "the quick brown fox"), (None, "no id here"), (11, "ﬁ ① Å 한글 é"), (12, "word " * 4000),
]


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies.read(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def test_ranks_give_the_ids_of_the_file(vocabularies):
    """Every code point, between letters, digits, blanks and signs, cut by ranks as by the file's own library."""
    ours, file = alignment.Cutter._ranks(vocabularies.a_json), alignment.Cutter._file(vocabularies.a_json)
    for start in range(0, 0x110000, 64):
        text = "".join(f" a{c}b {c}1{c} {c}{c}  {c}\n{c}?{c}'s{c}" for c in map(chr, range(start, start + 64)) if not "\ud800" <= c <= "\udfff")
        assert list(ours(text)) == list(file(text)), hex(start)


def test_other_files_are_not_taken_for_ranks():
    other = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "added_tokens": []}
    vocab = {c: k for k, c in enumerate(alignment.byte_level())}
    good = other | {"model": {"vocab": vocab | {"ab": 256}, "merges": ["a b"]}}
    assert alignment.ranked(json.dumps(good))[b"ab"] == 256
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": {"vocab": vocab | {"ab": 257, "cd": 256}, "merges": ["a b", "c d"]}}):
        assert alignment.ranked(json.dumps(good | change)) is None


def spans(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at = out[-1][1]
    return out


def plain(cutter, texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups of each text."""
    sides = [(spans(a, cutter.a_bytes), spans(b, cutter.b_bytes)) for a, b in zip(*cutter(texts))]
    links = [[(i, j) for s, e, i in a for x, y, j in b if s < y and x < e] for a, b in sides]
    count = Counter(x for own in links for x in own)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (a, b), own in zip(sides, links):
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [
            "|".join(",".join(str(i) for s, e, i in side if low < e <= high) for side in (a, b)) for low, high in zip([0, *ends], ends)
        ]
        out.append((len(a), len(b), len(groups), len(own), sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own), ";".join(groups)))
    return out


def test_equal_to_plain_walk(spark, vocabularies, monkeypatch):
    monkeypatch.setattr(alignment, "PART_BYTES", 64)
    texts = [x for x in TEXTS if len(x[1] or "") < 4000]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_a", F.lit("mine")).repartition(3)
    cutter = alignment.Cutter(vocabularies)
    want = sorted((str(i), *row[:6], sha256(row[6].encode()).hexdigest() if row[6] else "") for (i, _), row in zip(texts, plain(cutter, [x for _, x in texts])))
    assert sorted((str(r[0]), *r[1:]) for r in alignment.digests(docs, vocabularies).collect()) == want
    groups = {r.doc_id: r.groups for r in alignment.aligned(docs, vocabularies).collect()}
    assert groups[2] == plain(cutter, ["the quick brown fox"])[0][6] and groups[3] == groups[4] == ""


def test_texts_that_do_not_come_back(vocabularies):
    """U+2581 is a space to B; special strings are plain text."""
    cutter = alignment.Cutter(vocabularies)
    a, b = cutter(["a ▁ b", "<|endoftext|> <s>", "x"])
    assert a[0] == b[0] == [] and a[1] and b[1] and 50256 not in a[1]
    assert b"".join(cutter.a_bytes[i] for i in a[1]) == b" <|endoftext|> <s>"


def test_nothing_and_long(spark, vocabularies):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert alignment.digests(docs.limit(0), vocabularies).count() == 0
    got = alignment.digests(docs, vocabularies).collect()
    assert len(got) == len(TEXTS) and all((r.n_a == 0) == (r.groups_sha256 == "") for r in got)
    only = alignment.digests(docs.filter("doc_id in (3, 4)"), vocabularies).collect()
    assert sorted(tuple(r) for r in only) == [(3, 0, 0, 0, 0, 0, 0, ""), (4, 0, 0, 0, 0, 0, 0, "")]
