"""Write modes as pure functions ``(target, batch) -> new target``.

Plain parquet has no MERGE / DELETE, so each mode returns the whole new
content of the target; persisting it is a separate step (``store.save_table``),
which writes a new version folder.  Every mode is safe to rerun: applying the
same batch twice gives the same table.

Joins between a large target and a day's batch are written so that Spark can
pick the strategy from runtime sizes (AQE turns a small batch side into a
broadcast, and splits skewed partitions of the big side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.functions.time import DayLike, in_days, previous_day


def _conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like`` (by name, in its order and types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """First row per key under ``order_by``.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so every map task sends at most one row per key: a hot key costs
    no more than a cold one.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order_by: str = "update_ts") -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO UPDATE``, rows applied in ascending ``order_by``.

    The newest batch row per key wins (ties broken by the other columns, so the
    result does not depend on row order); target rows with that key are replaced.
    """
    batch = _conform(batch, target)
    others = [c for c in target.columns if c not in keys and c != order_by]
    latest = latest_per_key(batch, keys, [F.col(order_by).desc()] + [F.col(c).desc() for c in others])
    kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest)


def _outside(ts: str, lo: DayLike, hi: DayLike) -> Column:
    inside = in_days(ts, lo, hi)
    return ~inside | F.col(ts).isNull()


def replace_slice(target: DataFrame, batch: DataFrame, ts: str, day: DayLike) -> DataFrame:
    """Delete the day's rows, append the batch's rows of that day."""
    return replace_range(target, batch, ts, day, day)


def replace_range(target: DataFrame, batch: DataFrame, ts: str, lo: DayLike, hi: DayLike) -> DataFrame:
    """Delete rows whose ``ts`` day is in ``lo..hi`` and append the batch's rows of those days.

    The batch is cut to the same days, so a rerun cannot leave rows outside
    the replaced range behind.
    """
    kept = target.where(_outside(ts, lo, hi))
    fresh = _conform(batch.where(in_days(ts, lo, hi)), target)
    return kept.unionByName(fresh)


def replace_window(target: DataFrame, batch: DataFrame, ts: str, day: DayLike, days_back: int = 1) -> DataFrame:
    return replace_range(target, batch, ts, previous_day(day, days_back), day)


def replace_all(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``TRUNCATE`` + append (also ``DELETE FROM t`` + insert)."""
    return _conform(batch, target)


def insert_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT .. ON CONFLICT DO NOTHING``: existing keys win, batch duplicates collapse.

    The target is first cut to the batch's keys (see ``vault.new_keys``), so no join builds on the growing side.
    """
    fresh = _conform(batch, target).dropDuplicates(keys)
    known = target.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    return target.unionByName(fresh.join(known, keys, "left_anti"))


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """``DELETE FROM target WHERE key IN (SELECT key FROM ...)``."""
    return target.join(keys_df.select(*keys), keys, "left_anti")


def update_from(target: DataFrame, updates: DataFrame, keys: list[str], assignments: dict[str, Column],
                where: Column | None = None) -> DataFrame:
    """``UPDATE target SET col = expr FROM updates WHERE target.key = updates.key AND where``.

    ``assignments`` are expressions over ``updates``; ``where`` is over the
    target's columns.  If ``updates`` holds several rows for a key, the one with
    the greatest assigned values is used (the SQL statement leaves it open).
    """
    news = [f"_new_{c}" for c in assignments]
    u = updates.select(*keys, *[e.alias(n) for n, e in zip(news, assignments.values())], F.lit(True).alias("_hit"))
    u = latest_per_key(u, keys, [F.col(n).desc() for n in news])
    joined = target.join(u, keys, "left")
    cond = F.col("_hit").isNotNull()
    if where is not None:
        cond = cond & F.coalesce(where, F.lit(False))
    out = []
    for f in target.schema.fields:
        if f.name in assignments:
            out.append(F.when(cond, F.col(f"_new_{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return joined.select(*out)


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``INSERT INTO target SELECT ..`` / frame append / multi-row insert."""
    return target.unionByName(_conform(rows, target))


def advance_watermark(log: DataFrame, stage: DataFrame, name: str, ts: str = "update_ts",
                      name_col: str = "table_name") -> DataFrame:
    """Append ``(name, max(stage.ts))`` to the watermark log if it is newer than the logged one.

    An empty stage appends nothing.  Both maxima are scalar subqueries, so the
    new row is computed without bringing data to the driver.
    """
    from vaultspark.sources.ingest import high_watermark

    old = high_watermark(log, name, ts, name_col)
    new = stage.select(F.max(ts)).scalar()
    row = (log.sparkSession.range(1)
           .select(F.lit(name).alias(name_col), new.alias(ts))
           .where(F.col(ts) > old))
    return log.unionByName(_conform(row, log))


__all__ = [
    "advance_watermark", "append_rows", "delete_keys", "insert_absent", "latest_per_key", "replace_all",
    "replace_range", "replace_slice", "replace_window", "update_from", "upsert",
]
