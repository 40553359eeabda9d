"""Toxicity by a factorization machine over terms.

Besides one weight per term the model has a short vector per term; the dot product of the vectors of two
terms is the weight of meeting both in one text, which a linear model cannot express.

Terms are lower-case (A-Z) runs of letters, digits and non-ASCII bytes, and the first four and five bytes of
each (inflected and compounded words share them), each counted once per text and known by a hash of 64 bits, so that only
terms met in training score, however many others a text has. Terms
whose likelihood ratio with the label is small, in all texts and in those of each of the ``STRONGEST`` terms, carry no weight. The model is fitted on at most ``SAMPLE`` labelled
rows, those with the smallest hash of their id; scoring reads every text whole. Null and empty texts get the score of no terms. Repeated
label rows of a document count once (toxic if any says so); null labels are not learned from."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from mercato.llm.tables import widened
from mercato.llm.text import WordHashes, payloads, rows
from mercato.sources.tables import stage, unstage

PREFIXES = (4, 5)
RANK = 4
#: Most labelled rows the model is fitted on.
SAMPLE = 12_000
#: A term carries weight if its likelihood ratio statistic with the label is at least this.
LEAST_RATIO = 12.0
#: The same among the texts of one of the strongest terms; there are far more pairs than terms.
LEAST_PAIR_RATIO = 25.0
#: Terms by whose side partners are looked for: so many of the strongest.
STRONGEST = 256
#: Terms of texts that are counted against the strong ones at once.
PARTNER_ROWS = 8_192
EPOCHS = 12
FOLDS, HELD_FOLD = 5, 0

_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def fold(doc_id: Column) -> Column:
    """0 to 4, from the id alone."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def slots(text: bytes, known: WordHashes | None = None) -> np.ndarray:
    """Distinct hashes of the terms of a text."""
    terms = set(text.translate(_TERMS).split())
    for n in PREFIXES:
        terms |= {b"^" + t[:n] for t in terms if len(t) > n and t[0] != 94}
    known = WordHashes() if known is None else known
    return np.unique(known.of(list(terms)))


def likelihood_ratio(toxic_with: np.ndarray, with_: np.ndarray, toxic: int | np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """The G statistic of each term with the label, from the texts that have it; ``toxic`` of all ``n`` texts, or of those of each column."""
    total = np.zeros(with_.shape)
    for seen, rows, cols in (
        (toxic_with, with_, toxic), (with_ - toxic_with, with_, n - toxic),
        (toxic - toxic_with, n - with_, toxic), (n - with_ - (toxic - toxic_with), n - with_, n - toxic),
    ):
        expected = np.maximum(rows * cols / np.maximum(1, n), 1e-12)
        total += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / expected), 0)
    return total


def found(terms: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places in the sorted terms of those of the ids that are among them."""
    at = np.searchsorted(terms, ids)
    at[at == len(terms)] = 0
    return at[terms[at] == ids] if len(terms) else at[:0]


@dataclass
class Machine:
    """terms: sorted hashes of the terms that carry weight, with their weights and vectors."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, text: bytes, known: WordHashes | None = None) -> float:
        at = found(self.terms, slots(text, known))
        v = self.vectors[at]
        s = v.sum(0)
        z = self.bias + self.weights[at].sum() + 0.5 * float(s @ s - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def ratios(samples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of the samples, sorted, and the statistic of each."""
    counts = [np.unique(np.concatenate([np.empty(0, np.uint64), *own]), return_counts=True) for own in ([i for i, _ in samples], [i for i, y in samples if y])]
    (terms, used), (toxic_terms, times) = counts
    hit = np.zeros(len(terms), np.int64)
    hit[np.searchsorted(terms, toxic_terms)] = times
    return terms, likelihood_ratio(hit, used, sum(y for _, y in samples), len(samples))


def strongest(terms: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Sorted: so many of the terms with the greatest ratio (to six decimals; of equals those that come first)."""
    return np.sort(terms[np.lexsort((terms, -np.round(ratio, 6)))[:STRONGEST]])


def screened(samples: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Sorted terms that carry weight: those that say something of the label by themselves, and those that do among the texts of
    one of the strongest of these (a mention that is as frequent in clean as in toxic texts, but makes an insult an attack, or harmless)."""
    terms, ratio = ratios(samples)
    alone = terms[ratio >= LEAST_RATIO]
    top = strongest(alone, ratio[ratio >= LEAST_RATIO])
    texts: dict[int, list[int]] = {}
    for k, (ids, _) in enumerate(samples):
        for t in top[found(top, ids)].tolist():
            texts.setdefault(t, []).append(k)
    kept = [alone]
    for own in texts.values():
        if 0 < sum(samples[k][1] for k in own) < len(own):
            paired, ratio = ratios([samples[k] for k in own])
            kept.append(paired[ratio >= LEAST_PAIR_RATIO])
    return np.unique(np.concatenate(kept))


def trained(kept: np.ndarray, data: list[tuple[np.ndarray, int]], rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad, one text (places of its terms among those that carry weight, label) at a time in a fixed shuffled order; weights
    shrink towards 0."""
    toxic = sum(y for _, y in data)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(kept)), rng.normal(0, 0.02, (len(kept), rank))
    gw, gv = np.full(len(w), 1e-2), np.full(v.shape, 1e-2)
    bias = float(np.log((toxic + 0.5) / (len(data) - toxic + 0.5))) if data else -30.0
    for epoch in range(epochs):
        rate = 0.15 / (1 + epoch) ** 0.5
        for k in rng.permutation(len(data)):
            at, y = data[k]
            if not len(at):
                continue
            va = v[at]
            s = va.sum(0)
            z = bias + w[at].sum() + 0.5 * float(s @ s - (va * va).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            dw, dv = g + 2e-3 * w[at], g * (s - va) + 2e-3 * va
            gw[at] += dw * dw
            gv[at] += dv * dv
            w[at] -= rate * dw / np.sqrt(gw[at])
            v[at] -= rate * np.clip(dv, -1, 1) / np.sqrt(gv[at])
    return Machine(bias, kept, w.astype(np.float32), v.astype(np.float32))


def learn(samples: list[tuple[np.ndarray, int]], rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """The machine of texts held in memory, each as its terms and label."""
    kept = screened(samples)
    return trained(kept, [(found(kept, ids), y) for ids, y in samples], rank, epochs, seed)


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, ids array<bigint>, toxic) of the sampled labelled rows outside the held-out fold, one per id: of rows that repeat an id the one
    whose terms come first."""
    known = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_FOLD))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most `size` pairs of numbers, so broadcasting them is safe
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for b in rows(batches):
            ids = pa.array([slots(x, seen).view(np.int64) for x in payloads(b["text"])], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b["doc_id"], ids, b["toxic"]], ["doc_id", "ids", "toxic"])

    known = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", F.col("toxic").cast("int"))
    known = known.mapInArrow(hashed, "doc_id bigint, ids array<bigint>, toxic int")
    return known.groupBy("doc_id", "toxic").agg(F.min("ids").alias("ids"))


def ratio_column(hit: str, used: str, toxic: str, n: str) -> Column:
    """``likelihood_ratio`` of one term as a column: hit of the toxic of used texts have it, of toxic of n."""
    cells = [(f"{hit}", f"{used}", f"{toxic}"), (f"{used} - {hit}", f"{used}", f"{n} - {toxic}"),
             (f"{toxic} - {hit}", f"{n} - {used}", f"{toxic}"), (f"{n} - {used} - ({toxic} - {hit})", f"{n} - {used}", f"{n} - {toxic}")]
    parts = [f"CASE WHEN ({seen}) > 0 THEN 2 * ({seen}) * ln(({seen}) / (CAST({rows} AS DOUBLE) * ({cols}) / ({n}))) ELSE 0 END" for seen, rows, cols in cells]
    return F.expr(" + ".join(parts))


def screened_terms(sampled: DataFrame) -> np.ndarray:
    """The terms that carry weight, sorted, as ``screened`` has them, counted in Spark: those strong by themselves, and those strong among the
    texts of one of the strongest. A term of one text reaches no ``LEAST_PAIR_RATIO`` in a sample of ``SAMPLE`` texts, so partners are looked for among
    terms of two texts or more that are not strong already. Each of these is counted against all strong terms at once, in numbers beside each other, so that
rows grow with the terms of the texts and not with the pairs of them; the driver gets counts of terms and, of the sampled texts, the places
of strong terms."""
    total = sampled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("all_toxic"))
    each = sampled.select("toxic", F.explode("ids").alias("term"))
    counts = each.groupBy("term").agg(F.count(F.lit(1)).alias("used"), F.sum("toxic").alias("hit")).crossJoin(F.broadcast(total))
    ratio = ratio_column("hit", "used", "all_toxic", "n")
    got = counts.select("term", ratio.alias("ratio")).filter((F.col("ratio") >= LEAST_RATIO) | (F.col("used") > 1)).toArrow()  # of a bounded sample
    terms, ratios_ = got["term"].to_numpy().astype(np.int64).view(np.uint64), got["ratio"].to_numpy().astype(np.float64)
    is_strong = ratios_ >= LEAST_RATIO
    alone, others = np.sort(terms[is_strong]), np.sort(terms[~is_strong])
    top = strongest(terms[is_strong], ratios_[is_strong])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [x.values.to_numpy().view(np.uint64) if len(x.values) else np.empty(0, np.uint64) for x in b["ids"]]
            sides = [pa.array([found(top, x).astype("<i2").tobytes() for x in ids], pa.binary())]
            sides.append(pa.array([others[found(others, x)].view(np.int64) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], *sides], ["doc_id", "toxic", "strong", "others"])

    sides = stage(sampled.select("doc_id", "toxic", "ids").mapInArrow(split, "doc_id bigint, toxic int, strong binary, others array<bigint>"), "term-sides")
    # of a bounded sample, the texts that have a strong term: their labels and the places of at most STRONGEST terms
    texts = sides.select("doc_id", "toxic", "strong").filter("length(strong) > 0").orderBy("doc_id").toArrow()
    doc_ids, labels = texts["doc_id"].to_numpy(), texts["toxic"].to_numpy().astype(np.int64)
    has = np.zeros((len(doc_ids), len(top)), np.uint8)
    for k, x in enumerate(texts["strong"].to_pylist()):
        has[k, np.frombuffer(x, "<i2")] = 1
    n, all_toxic = has.sum(0, dtype=np.int64), has[labels > 0].sum(0, dtype=np.int64)
    both = (0 < all_toxic) & (all_toxic < n)
    has, n, all_toxic = has[:, both], n[both], all_toxic[both]
    if not has.size:
        unstage(sides)
        return alone

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Terms that say something in the texts of a strong one. The texts of a term come one after the other."""
        last, used, hit = None, np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)

        def say(terms: np.ndarray, used: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
            ratio = likelihood_ratio(hit, used, all_toxic, n)
            good = ((used > 0) & (ratio >= LEAST_PAIR_RATIO)).any(1)
            return pa.RecordBatch.from_arrays([pa.array(terms[good], pa.int64())], ["term"])

        for b in batches:
            for at in range(0, b.num_rows, PARTNER_ROWS):
                part = b.slice(at, PARTNER_ROWS)
                terms, own = part["term"].to_numpy(), np.searchsorted(doc_ids, part["doc_id"].to_numpy())
                starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
                met = has[own]
                counts = [np.add.reduceat(x, starts, 0, np.int64) for x in (met, met * (labels[own] > 0)[:, None])]
                if terms[0] == last:
                    counts[0][0] += used
                    counts[1][0] += hit
                elif last is not None:
                    yield say(np.array([last]), used[None], hit[None])
                yield say(terms[starts[:-1]], counts[0][:-1], counts[1][:-1])
                last, used, hit = terms[-1], counts[0][-1], counts[1][-1]
        if last is not None:
            yield say(np.array([last]), used[None], hit[None])

    # a row per term of a text, never one per pair of terms: the texts of a term meet in one task, at most as many as are sampled
    met = sides.filter("length(strong) > 0").select("doc_id", F.explode("others").alias("term"))
    met = met.repartition("term").sortWithinPartitions("term")
    paired = met.mapInArrow(partners, "term bigint").toArrow()["term"]
    unstage(sides)
    return np.union1d(alone, paired.to_numpy().astype(np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Machine:
    """Terms are counted and screened in Spark; the driver gets the terms that carry weight and, of at most ``size`` texts, the places of
    their terms among these."""
    sampled = stage(sample(docs, labels, size), "labelled-terms")
    kept = screened_terms(sampled)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [found(kept, x.values.to_numpy().view(np.uint64)).astype("<i4").tobytes() if len(x.values) else b"" for x in b["ids"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(at, pa.binary()), b["toxic"]], ["doc_id", "at", "toxic"])

    got = sampled.select("doc_id", "ids", "toxic").mapInArrow(placed, "doc_id bigint, at binary, toxic int").collect()
    machine = trained(kept, [(np.frombuffer(r.at, "<i4"), r.toxic) for r in sorted(got)])
    unstage(sampled)
    return machine


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """The rows with ``toxicity`` (double) added; a column of that name is replaced. No shuffle."""
    docs = docs.drop("toxicity")
    schema = widened(docs, toxicity=DoubleType())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for b in rows(batches):
            got = pa.array([machine.score(x, seen) for x in payloads(b[text])], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, got], [*b.schema.names, "toxicity"])

    return docs.mapInArrow(scored, schema)
