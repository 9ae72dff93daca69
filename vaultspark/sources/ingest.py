"""Scans of sources and staging tables (incremental, day slice, window, full)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.functions.json import json_field
from vaultspark.functions.time import LOW_WATERMARK, DayLike, day_lit, in_days, previous_day, text_day, ts_lit


# ---------------------------------------------------------------- high watermark

def high_watermark(log: DataFrame, name: str, ts: str = "update_ts", name_col: str = "table_name") -> Column:
    """Latest logged time of collection ``name`` (1900-01-01 when none), as a
    scalar subquery: it stays part of the plan and is evaluated once."""
    latest = log.where(F.col(name_col) == name).select(F.max(ts))
    return F.coalesce(latest.scalar(), ts_lit(LOW_WATERMARK))


def high_watermarks(log: DataFrame, names: list[str], ts: str = "update_ts",
                    name_col: str = "table_name") -> DataFrame:
    """One row per requested collection: ``(table_name, high_watermark)``.

    The log is reduced to one row per collection before the names are matched,
    so the join input is bounded by the number of collections.
    """
    spark = log.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], T.StructType([T.StructField(name_col, T.StringType())]))
    latest = log.where(F.col(name_col).isin(names)).groupBy(name_col).agg(F.max(ts).alias("_max"))
    return wanted.join(latest, name_col, "left").select(
        name_col, F.coalesce("_max", ts_lit(LOW_WATERMARK)).alias("high_watermark"))


def incremental_scan(df: DataFrame, watermark: Column | str | dt.datetime, ts: str = "update_ts") -> DataFrame:
    """Rows strictly newer than the watermark (ties with it are skipped, as in the source query)."""
    wm = watermark if isinstance(watermark, Column) else ts_lit(watermark)
    return df.where(F.col(ts) > wm)


# ---------------------------------------------------------------- slices

def date_slice(df: DataFrame, ts: str, day: DayLike) -> DataFrame:
    """Rows whose timestamp falls on ``day`` (pushed to the scan as a range)."""
    return df.where(in_days(ts, day))


def window_slice(df: DataFrame, ts: str, day: DayLike, days_back: int = 1) -> DataFrame:
    """Rows whose timestamp falls on ``day - days_back`` .. ``day`` (inclusive days)."""
    return df.where(in_days(ts, previous_day(day, days_back), day))


def business_day(stage: DataFrame, path: str = "$.date", value: str = "object_value") -> Column:
    """Date written inside the staged JSON text (ANSI cast: malformed text fails)."""
    return text_day(json_field(value, path))


def business_day_slice(stage: DataFrame, day: DayLike, path: str = "$.date", days_back: int = 0,
                       value: str = "object_value", date_col: str = "order_date") -> DataFrame:
    """Staged documents whose business date (inside the JSON) is in ``day - days_back .. day``.

    When the stage carries the date as a column (``date_col``) the filter is on
    that column (pushed to the scan, prunes date partitions); otherwise the
    date is read out of the JSON text of every row.
    """
    d = F.col(date_col) if date_col in stage.columns else business_day(stage, path, value)
    if days_back == 0:
        return stage.where(d == day_lit(day))
    return stage.where(d.between(day_lit(previous_day(day, days_back)), day_lit(day)))


def event_slice(outbox: DataFrame, event_type: str, day: DayLike, path: str = "$.order_date") -> DataFrame:
    """Outbox events of one type whose business date (inside the JSON) is ``day``."""
    typed = outbox.where(F.col("event_type") == event_type)
    return typed.where(text_day(json_field("event_value", path)) == day_lit(day))


# ---------------------------------------------------------------- full scans and readers

def full_scan(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """All rows and columns, with optional renames (``id`` -> ``bonus_user_id``)."""
    return df.withColumnsRenamed(renames) if renames else df


def read_source(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None,
                **options: str) -> DataFrame:
    """Any Spark source: ``parquet``, ``json``, ``jdbc`` (options passed through), ..."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def land_json(df: DataFrame, path: str, records_per_file: int | None = None) -> str:
    """Write objects as JSON lines (how fetched service pages are landed)."""
    w = df.write.mode("errorifexists").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if records_per_file:
        w = w.option("maxRecordsPerFile", records_per_file)
    w.json(path)
    return path


def read_landed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed objects bound to the declared schema **by field name** (never by position)."""
    return (spark.read.schema(schema)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .json(path))


def read_landed_pages(spark: SparkSession, path: str, schema: T.StructType, ts: str, day: DayLike,
                      days_back: int = 1) -> DataFrame:
    """All landed pages of a paged fetch as one DataFrame, cut to ``[day - days_back, day + 1)``.

    Paging and the sort requested from the service do not change the result,
    so pages are read together; no dedupe is applied (the source applies none).
    """
    return window_slice(read_landed_json(spark, path, schema), ts, day, days_back)
