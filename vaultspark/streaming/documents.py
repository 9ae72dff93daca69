"""Incremental document staging as a Structured Streaming query.

The batch load keeps a high-watermark log and asks the source for documents
newer than it.  When the source lands its documents as files, a file stream
does the bookkeeping: the query's checkpoint records which files were already
processed, so each run (``availableNow``: everything landed so far, then stop)
sees only new files.  Each micro-batch is one load:

1. watermark = the newest ``update_ts`` that the batches before it staged, from the batch ledger (1900-01-01 at first);
2. keep documents strictly newer than it (as the source query does);
3. upsert them into the stage, a day table: only the days of the batch's documents and of the versions they replace
   are rewritten, whatever the history;
4. enter the batch and its watermark in the ledger.

A micro-batch that is retried after step 4 is skipped; one that failed between 3 and 4 starts from the same watermark
and repeats the same upsert, which changes nothing that is already there.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.functions.json import to_document
from vaultspark.functions.time import LOW_WATERMARK, ts_lit
from vaultspark.schemas import TABLES
from vaultspark.sources.store import conform, day_table, empty_table, path_exists, read_days, upsert_days

LEDGER = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType()),
                       T.StructField("watermark", T.TimestampNTZType())])


def _ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/batch_ledger"
    return spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], LEDGER)


def read_stage(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The stage as the last micro-batch left it: empty before the first one."""
    if not path_exists(spark, f"{root.rstrip('/')}/{table}"):
        return empty_table(spark, table)
    return read_days(spark, day_table(spark, root, table), table)


def load_batch(batch: DataFrame, query_id: str, batch_id: int, root: str, table: str,
               writer: Callable[[DataFrame], DataFrame] = to_document, ts: str = "update_ts", day: str = "update_ts") -> bool:
    """Stage one micro-batch; False if the ledger has it already.  ``day``: the stage's column that gives a row's partition.

    A batch whose predecessor of the same query is missing from the ledger is an error: going on would lose documents.
    """
    spark = batch.sparkSession
    ledger = _ledger(spark, root)
    done = ledger.where(F.col("query_id") == query_id)
    known, newest = done.agg(F.max("batch_id")).first()[0], ledger.agg(F.max("watermark")).first()[0]
    if known is not None and batch_id <= known:
        return False
    if batch_id != (0 if known is None else known + 1):
        raise RuntimeError(f"batch {batch_id} follows batch {known} of the ledger in {root}")
    low = ts_lit(newest or LOW_WATERMARK)
    fresh = conform(writer(batch.where(F.col(ts) > low)), table)
    stage = day_table(spark, root, table)
    fresh = fresh.checkpoint(eager=True)  # the source files are read once
    upsert_days(spark, stage, table, fresh, ["object_id"], "update_ts", day)
    mark = fresh.agg(F.coalesce(F.max("update_ts"), low).alias("watermark"))
    entry = mark.select(F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"), "watermark")
    entry.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/batch_ledger")
    return True


def stage_documents_stream(spark: SparkSession, landing: str, object_schema: T.StructType, stage_root: str,
                           checkpoint: str, table: str,
                           writer: Callable[[DataFrame], DataFrame] = to_document,
                           ts: str = "update_ts", day: str | None = None) -> int | None:
    """Run the staging stream over everything landed so far; return the last batch staged (None if none).

    The stage's partitions are the business dates of documents that have one, else the days of their updates.
    """
    stream = (spark.readStream.schema(object_schema)
              .option("mode", "FAILFAST")
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
              .json(landing))
    by = day or ("order_date" if "order_date" in TABLES[table].fieldNames() else "update_ts")
    last: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        query_id = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        if load_batch(batch, query_id, batch_id, stage_root, table, writer, ts, by):
            last.append(batch_id)

    query = (stream.writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return last[-1] if last else None
