"""Corpus pipeline: quality, near duplicates, decontamination, PII, tokens.

Each stage works on all rows that its predecessor kept; all but the last return the columns of
documents. Edge cases of the operators hold here too: null and empty texts pass every filter that
they don't fail, rows without an id are never taken for copies or leaks, columns beyond those of
documents pass through (the last stage returns its own), empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.llm import decontam, pieces, pii, quality
from triage.llm.common import cut, table
from triage.llm.jaccard import jaccard_join
from triage.llm.queries import fifth
from triage.session import checkpoint_dir

KEEP_SCORE = 0.3        # documents of a lower quality score go
BROADCAST_IDS = 1_000_000  # ids that are broadcast at most (some 50 MB); more are joined by shuffle


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not in ``ids(doc_id)``; rows without an id stay."""
    ids = cut(ids.filter("doc_id is not null").distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_anti").select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier scores at KEEP_SCORE or more."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", where=fifth() != 0)
    cols = docs.columns
    return quality.with_score(docs.drop("score"), model).filter(F.col("score") >= KEEP_SCORE).select(
        [c for c in cols if c != "score"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the document with the smallest id of each group stays.

    Five-word shingles at a similarity of 0.8 or more. Texts without a word are copies of nothing;
    of rows equal in id and text one stays.
    """
    found = cut(jaccard_join(docs, size=5, num=80, den=100))
    again = cut(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    kept = without(docs, found.filter("doc_id <> component_id").select("doc_id"))
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return without(kept, again).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without(docs, decontam.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind; n_chars follows the text."""
    out = pii.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, lossless) of every document left."""
    return pieces.encoded(docs, dropout=0.1, seed=1).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminate), ("PII", mask_pii), ("SentencePiece", tokens)]
# a trained classifier and seeded segmentation have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        at = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
