"""From documents to token digests in five stages. Each stage takes (spark, docs, sf_dir), with docs what the stage
before it left, and returns a frame with the columns of documents; the last returns a digest of the tokens."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mercato.llm import anchors, bpe, jaccard, mixing, toxicity  # noqa: E402
from mercato.llm.queries import tokenizer  # noqa: E402
from mercato.llm.tables import lookup  # noqa: E402
from mercato.sources.readers import table  # noqa: E402
from mercato.sources.tables import stage, unstage  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows of whole texts that go to a Python worker at once; Spark's default of 10,000 is meant for short rows.
BATCH_ROWS = 500
#: Text of a block of the substring stage: half of what the operator takes by itself, because workers still hold what earlier stages left.
REPEAT_BLOCK_BYTES = 3_000_000
#: Near copies of the pipeline: words of a shingle, and least similarity in hundredths.
NEAR_WIDTH, NEAR_LEAST = 5, 80


def small_batches(spark: SparkSession) -> None:
    """For the session: how rows are cut into Arrow batches changes memory only, never a result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, learned from the labels of documents that are here; also a document that was learned from is
    judged by its score."""
    small_batches(spark)
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).filter("toxicity < 0.5").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar 5-word sets hold together, the one with the smallest id. Rows that repeat that id
    all stay, as rows without an id do."""
    small_batches(spark)
    gone = jaccard.join(docs, width=NEAR_WIDTH, least=NEAR_LEAST).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(lookup(gone, jaccard.BROADCAST_IDS), "doc_id", "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; a document that is nothing else stays, with an empty text. What loses
    no word keeps its text as it is, white space included; other texts become their kept words, joined by one space."""
    small_batches(spark)
    cut = anchors.dedup(docs.select(*COLUMNS), REPEAT_BLOCK_BYTES)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources towards the square root of their numbers of documents; a document comes as often as drawn."""
    return mixing.replicate(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every copy."""
    small_batches(spark)
    return bpe.digests(docs, tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("n-gram jaccard join", one_of_each),
    ("substring dedup", cut_repeats),
    ("source mixing", mix),
    ("byte-level bpe", encode),
]

#: None: the fitted scores of the first stage are beyond SQL; tests hold each stage against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        before, docs = docs, step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
            unstage(before)
    return docs
