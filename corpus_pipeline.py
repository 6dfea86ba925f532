"""Corpus pipeline: documents to packed training sequences.

Five stages, each a Spark job over all that its predecessor kept: quality classifier, language
identification, near-duplicate removal, benchmark decontamination, packing. Every stage's result is
written as Parquet to the shared checkpoint folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroseries.llm import decontam, langid, minhash, packing, quality
from macroseries.llm.common import free_name, table, write_once
from macroseries.llm.queries import learnable

MIN_LANGUAGE_SCORE = 0.3
# runs and pieces whose ids a packing worker keeps: fewer than for packing alone, since workers and
# executors still hold memory of the four stages before
PACKING_KEPT = (400_000, 150_000)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; it learns from the labelled documents."""
    weights = quality.fit(table(spark, sf_dir, "documents"),
                          learnable(table(spark, sf_dir, "labels")))
    s = free_name(docs, "quality_score")
    return docs.withColumn(s, quality.score(docs, weights)).filter(F.col(s) >= 0.5).drop(s)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language: not ``und`` and at least ``MIN_LANGUAGE_SCORE``."""
    model = langid.fit(learnable(table(spark, sf_dir, "documents")))
    p = free_name(docs, "language")
    return docs.withColumn(p, langid.predict(docs, model)).filter(
        (F.col(p)["lang_pred"] != "und") & (F.col(p)["score"] >= MIN_LANGUAGE_SCORE)).drop(p)


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined to (doc_id, text_hash); NULL ids are matched too."""
    h = free_name(docs, "text_hash")
    d = docs.withColumn(h, F.xxhash64("text"))
    k = keys.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h")).distinct()
    return d.join(k, d["doc_id"].eqNullSafe(k["__id"]) & (d[h] == k["__h"]), how), h


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component (five-word shingles,
    similarity 0.8); a row that repeats a document's id and text goes too."""
    found = minhash.near_duplicates(docs, width=5)
    out, h = _matching(docs, found.filter("kept"), "left_semi")
    return out.dropDuplicates(["doc_id", h]).select(*[out[c] for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = write_once(decontam.contaminated(docs, table(spark, sf_dir, "benchmark")), "leaks")
    out, h = _matching(docs, found, "left_anti")
    return out.drop(h)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of at most 4096 tokens."""
    return packing.pack(docs, packing.vocabulary_path(), kept=PACKING_KEPT)


STAGES = [
    ("quality_classifier", quality_stage),
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# learned models, MinHash and a tokenizer are beyond SQL; tests/llm tests each stage's operator
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
