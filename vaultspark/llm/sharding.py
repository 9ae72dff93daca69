"""Contiguous shards of equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import shuffle_partitions, written


def assign_shards(sizes: DataFrame, shards: int = 8, order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``sizes`` (with a positive long ``size``) plus ``shard`` and ``slot``; native columns only.

    Rows are range-partitioned in ``order`` (nulls first) and written; the totals of each range partition give its
    global byte and row offset, a running sum inside the partition the rest.  A row belongs to the shard in whose
    equal share of all bytes its middle byte lies, so shards are contiguous in ``order`` and each holds an equal
    share to within the largest row on either side.  ``slot`` counts a shard's rows from 0.  Rows equal in all of ``order`` are
    interchangeable.  An empty table gives no rows.  Only the per-partition totals (one row a partition) and the
    first row number of each shard are broadcast.
    """
    spark = sizes.sparkSession
    ranged = written(sizes.repartitionByRange(shuffle_partitions(spark), *order)
                     .withColumn("_part", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"), F.sum("_bytes").over(everything).alias("_all"))
    inside = Window.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (ranged.withColumn("_end", F.sum("size").over(running)).withColumn("_nr", F.row_number().over(inside))
              .join(F.broadcast(offsets), "_part")
              .withColumn("_middle", 2 * (F.col("_byte0") + F.col("_end")) - F.col("size"))
              .withColumn("shard", F.expr(f"cast(least({shards - 1}, (_middle * {shards}) div (2 * _all)) as int)"))
              .withColumn("_row", F.col("_row0") + F.col("_nr") - 1))
    placed = written(placed.drop("_end", "_nr", "_byte0", "_row0", "_all", "_middle", "_part"), "placed")
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # one row a shard
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("_row") - F.col("_first")).drop("_row", "_first")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of every row, in doc_id order.

    A null text has no bytes (size 1, checksum of the empty text); a null doc_id comes first; rows that share a
    doc_id are ordered by checksum and size.  Further columns of ``docs`` are not read.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sizes = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    return assign_shards(sizes, shards, ("doc_id", "text_crc32", "size"))
