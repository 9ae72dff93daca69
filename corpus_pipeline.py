"""The training-data pipeline: documents in, packed sequences out.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and calls one operator of
``vaultspark.llm``; its result is written as Parquet and reread as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm import decontam, linear, linededup, quality, simhash
from vaultspark.llm.common import free_name, read, written
from vaultspark.llm.queries import packed_digest

QUALITY_THRESHOLD = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; held-out labels (the fold of the quality query) stay unused."""
    labels = read(spark, sf_dir, "labels")
    model = quality.train_quality(docs, labels.where(linear.fold("doc_id", 5) != 0))
    score = free_name("quality_score", docs.columns)
    scored = linear.score(docs, model, quality.word_ngrams, docs.columns, score)
    return scored.where(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that later documents repeat; ``n_chars`` follows the text."""
    kept = linededup.dedup_lines(docs, counts=False)
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near-duplicates the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, width=4, max_bits=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: where its tokens lie."""
    return packed_digest(docs)


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]

ORACLE_SQL = None  # the classifier, the fingerprints and the tokenizer are beyond SQL; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
