"""One registered query per operator: the operator on its whole table, then the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm import (
    decontam, linededup, mixing, packing, phrases, pii, quality, sharding, simhash, topk, toxicity, warc, whitening,
)
from vaultspark.llm.common import read


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), width=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [k.name for k in pii.KINDS if k.base]
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return pii.find_personal_data(read(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined([k.name for k in pii.KINDS]).alias("spans"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = warc.archive_pages(read(spark, sf_dir, "pages"))
    return warc.read_archives(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def packed_digest(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs)
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), 5, 0, 0.3).select(
        "doc_id", "held_out", "score", "predicted")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), 3, 1, 0.7).select(
        "doc_id", "held_out", "score", "predicted")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(read(spark, sf_dir, "documents"), max_words=3, min_count=10, overlap=50, top=2000)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=4, scale=256).withColumn(
        "deviation", F.col("deviation").cast("long"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_shards, op2_simhash, op3_personal_data, op4_warc, op5_packing, op6_line_dedup,
                            op7_decontamination, op8_quality, op9_top_k, op10_toxicity, op11_phrases, op12_whitening, op13_mixing)}
