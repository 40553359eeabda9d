"""The registered queries of the operators, over whole tables, with the parameters of production."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import alignment, anchors, bpe, chat, covertree, fingerprints, jaccard, mixer, mixing, quality, spelling, toxicity, warc
from mercato.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from mercato.session import staging_dir
from mercato.sources.readers import table


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return got.select("doc_id", *base, "base_failed", "kept", "reasons")


#: Copies by inverting the Poisson distribution of a source's rate, of parts of at most 16, at the uniform number of id and part.
MIXING_SQL = """
WITH RECURSIVE n AS (SELECT coalesce(source, '') AS s, count(*)::DOUBLE AS n_rows FROM documents GROUP BY 1),
r AS MATERIALIZED (
  SELECT s, pow(n_rows, 0.5) / sum(pow(n_rows, 0.5)) OVER () * sum(n_rows) OVER () / n_rows AS rate FROM n),
p AS MATERIALIZED (SELECT s, greatest(1, ceil(rate / 16))::INT AS parts, rate / greatest(1, ceil(rate / 16)) AS rate FROM r),
cdf(s, rate, k, term, total) AS (
  SELECT s, rate, 0, exp(-rate), exp(-rate) FROM p
  UNION ALL SELECT s, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM cdf WHERE k < 79),
draws AS (
  SELECT d.*, p.s, unnest(range(1, parts + 1)) AS part FROM documents d JOIN p ON coalesce(d.source, '') = p.s),
u AS (
  SELECT *, ('0x' || substr(md5('mix-1:' || doc_id || ':' || part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM draws),
copies AS (
  SELECT doc_id, text, lang, source, n_chars, (SELECT count(*) FROM cdf c WHERE c.s = u.s AND c.total <= u.u) AS k FROM u),
summed AS (SELECT doc_id, text, lang, source, n_chars, sum(k)::INT AS copies FROM copies GROUP BY ALL),
each AS (SELECT * EXCLUDE (copies), unnest(range(1, copies + 1))::INT AS copy_no FROM summed)
SELECT *, ('0x' || substr(md5('mix-1:place:' || doc_id || ':' || copy_no), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS shuffle_key FROM each
"""


@query("op7_source_mixing", MIXING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents")).drop("rate")


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_FOLD, F.lit(False))
    scored = toxicity.score(docs.select("doc_id", "text"), machine)
    return scored.select(
        "doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def tokenizer(path: str | None = None, pattern: str | None = None) -> bpe.Tokenizer:
    """The public tokenizer of the contract, or another file of ranks."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.Tokenizer(bpe.read_ranks(path), pattern or public_tokenizers.PATTERN)


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer())


#: 20-word windows that also start earlier; words by position (from 1), in order of id and position.
REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS p FROM w WHERE len(words) >= 20),
marked AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(words[p:p + 19], ' ') ORDER BY doc_id, p) > 1 AS again FROM starts
),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM marked WHERE again),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op9_substring_dedup", REPEATS_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.digest(table(spark, sf_dir, "documents"))


#: Similar pairs of whole texts by their 3-word shingles, then the least id that links reach.
JACCARD_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda p: array_to_string(words[p:p + 2], ' ')) END) AS grams FROM w),
g AS MATERIALIZED (SELECT doc_id, len(grams) AS n, md5_number_lower(unnest(grams)) AS gram FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * shared >= 90 * (na + nb - shared)),
reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, len(grams) AS n_shingles, least(s.doc_id, coalesce(min(other), s.doc_id)) AS component_id
FROM s LEFT JOIN reach USING (doc_id) GROUP BY s.doc_id, grams
"""


@query("op6_ngram_jaccard", JACCARD_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op10_context_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixer.score(table(spark, sf_dir, "documents"))


#: Equal payloads of 100 bytes or more, by their hash; page ids are unique in the test tables.
WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@query("op2_warc_bundles", WARC_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{staging_dir(spark)}/warc-{uuid.uuid4().hex}"
    return warc.read_back(warc.write(table(spark, sf_dir, "pages"), folder), folder)


VECTORS_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
reach(vec_id, other) AS (SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT vec_id, min(other) AS least_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, least(e.vec_id, coalesce(least_id, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(least_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""


@query("op5_cover_tree", VECTORS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_chat_transcripts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recover(chat.transcripts(table(spark, sf_dir, "conversations")))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    return alignment.digests(table(spark, sf_dir, "documents"), alignment.Vocabularies.read(*map(public_tokenizers.path, files)))


#: CRC-32 bit by bit over the bytes of id and run; near words by equal patterns with a gap and by deletions.
SPELLING_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
each AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM d),
runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM each WHERE length(run) >= 6 GROUP BY ALL),
bits AS (
  SELECT *, flatten(list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
    lambda x: [('0x' || x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS b FROM runs),
crc AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(list_concat([4294967295], b),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))) AS h FROM bits),
v AS MATERIALIZED (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n FROM crc GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
cuts AS MATERIALIZED (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM v),
less AS MATERIALIZED (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM cuts),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT l.word, v.word FROM less l JOIN v ON l.rest = v.word
  UNION SELECT v.word, l.word FROM less l JOIN v ON l.rest = v.word),
ranked AS (
  SELECT near.word, other, v.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, other) AS place FROM near JOIN v ON v.word = other),
formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
    CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON v.word = r.word),
way(word, reached, depth) AS (
  SELECT word, word, 0 FROM formed UNION ALL SELECT w.word, f.form, depth + 1 FROM way w JOIN formed f ON w.reached = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(w.reached, w.depth) AS root, f.n, f.n_near, f.form_n FROM formed f JOIN way w ON f.word = w.word GROUP BY ALL
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


#: Three-byte runs of own and edited texts by bucket, classes by the quartiles of the counts, distances of classes.
FINGERPRINT_SQL = """
WITH o AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS k, count(*) OVER () AS n FROM documents),
pairs AS MATERIALIZED (
  SELECT a.doc_id, a.k, b.k AS next_k, length(a.text) AS n_chars, a.text,
    substr(a.text, 1, length(a.text) - length(a.text) // 2) || substr(b.text, 1, length(a.text) // 2) AS edited
  FROM o a JOIN o b ON b.k = a.k % a.n + 1),
texts AS (SELECT k, 0 AS kind, text AS x FROM pairs UNION ALL SELECT k, 1, edited FROM pairs),
bytes AS (
  SELECT k, kind, octet_length(encode(x)) AS size,
    list_transform(regexp_extract_all('0000' || hex(encode(x)) || '0000', '..'), lambda d: ('0x' || d)::BIGINT) AS b FROM texts),
hits AS (
  SELECT k, kind, unnest(list_transform(range(1, len(b) - 1), lambda i: ((b[i] * 65536 + b[i + 1] * 256 + b[i + 2]) * 2654435761 % 4294967296) // 4194304)) AS bucket
  FROM bytes),
counted AS (SELECT k, kind, bucket, count(*) AS c FROM hits GROUP BY ALL),
every AS MATERIALIZED (
  SELECT b.k, b.kind, r.bucket, coalesce(c, 0) AS c FROM (SELECT k, kind FROM bytes) b CROSS JOIN (SELECT unnest(range(0, 1024)) AS bucket) r
  LEFT JOIN counted USING (k, kind, bucket)),
cuts AS (SELECT k, kind, list_sort(list(c)) AS s FROM every GROUP BY ALL),
classes AS MATERIALIZED (
  SELECT k, kind, bucket, (c > s[256])::INT + (c > s[512])::INT + (c > s[768])::INT AS class FROM every JOIN cuts USING (k, kind)),
digits AS (
  SELECT k, kind, bucket // 2 AS place, sum(class * CASE WHEN bucket % 2 = 0 THEN 4 ELSE 1 END)::INT AS digit FROM classes GROUP BY ALL),
body AS (SELECT k, kind, string_agg(substr('0123456789abcdef', digit + 1, 1), '' ORDER BY place) AS body FROM digits GROUP BY ALL),
prints AS MATERIALIZED (
  SELECT k, kind, least(255, floor(8 * log2(size + 1)))::INT AS len, body FROM body JOIN bytes USING (k, kind)),
named AS MATERIALIZED (SELECT k, kind, len, lpad(lower(hex(len)), 2, '0') || body AS fingerprint FROM prints),
wanted AS (SELECT k, k AS other, 1 AS kind FROM pairs UNION ALL SELECT k, next_k, 0 FROM pairs),
apart AS (
  SELECT w.k, w.kind, sum(abs(a.class - b.class)) AS d FROM wanted w JOIN classes a ON a.k = w.k AND a.kind = 0
  JOIN classes b ON b.k = w.other AND b.kind = w.kind AND b.bucket = a.bucket GROUP BY ALL),
likeness AS MATERIALIZED (
  SELECT w.k, w.kind, 1 - (d + 21 * least(16, abs(a.len - b.len)))::DOUBLE / 3408 AS near
  FROM wanted w JOIN apart USING (k, kind) JOIN named a ON a.k = w.k AND a.kind = 0 JOIN named b ON b.k = w.other AND b.kind = w.kind)
SELECT p.doc_id, p.n_chars, sha256(p.edited) AS edited_sha256, a.fingerprint, e.fingerprint AS edited_fingerprint,
  x.near AS near_edited, y.near AS near_next
FROM pairs p JOIN named a ON a.k = p.k AND a.kind = 0 JOIN named e ON e.k = p.k AND e.kind = 1
JOIN likeness x ON x.k = p.k AND x.kind = 1 JOIN likeness y ON y.k = p.k AND y.kind = 0
"""


@query("op12_fingerprints", FINGERPRINT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(table(spark, sf_dir, "documents"))
