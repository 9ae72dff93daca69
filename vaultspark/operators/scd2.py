"""Versioned (SCD2) satellites.

A version is ``(key, attrs.., active_from, active_to)``; the open version has
``active_to = OPEN_TO``.  A change closes the open version at ``update_ts - 1 ms``
and opens a new one at ``update_ts``.  The change test is SQL's ``!=`` (a NULL
on either side is no change) unless ``null_safe=True``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspark.functions.predicates import changed
from vaultspark.functions.time import OPEN_TO, minus_one_ms, ts_lit
from vaultspark.operators.writes import latest_per_key, update_from

FROM, TO = "active_from", "active_to"


def _open() -> Column:
    return F.col(TO) == ts_lit(OPEN_TO)


def latest_versions(sat: DataFrame, key: str) -> DataFrame:
    """Latest version per key (greatest ``active_to``) -- what ``DISTINCT FIRST_VALUE(..) OVER
    (PARTITION BY key ORDER BY active_to DESC)`` computes."""
    return latest_per_key(sat, [key], [F.col(TO).desc_nulls_first()])


def reduce_batch(batch: DataFrame, key: str, attrs: list[str], ts: str = "update_ts") -> DataFrame:
    """One batch row per key: newest ``ts``, then greatest attributes (deterministic)."""
    return latest_per_key(batch, [key], [F.col(ts).desc()] + [F.col(a).desc_nulls_last() for a in attrs])


def _compare(sat: DataFrame, batch: DataFrame, key: str, attrs: list[str], ts: str) -> DataFrame:
    """Batch rows next to the latest version of their key (only keys of the batch are read)."""
    touched = sat.join(batch.select(key), key, "left_semi")
    latest = latest_versions(touched, key).select(
        key, *[F.col(a).alias(f"_o_{a}") for a in attrs], F.col(TO).alias("_o_to"), F.lit(True).alias("_o_hit"))
    return batch.select(key, *attrs, ts).join(latest, key, "left")


def scd2_close(sat: DataFrame, batch: DataFrame, key: str, attrs: list[str], ts: str = "update_ts",
               null_safe: bool = False) -> DataFrame:
    """Close open versions whose attributes differ from the batch: ``active_to = update_ts - 1 ms``."""
    open_rows = sat.where(_open()).select(key, *[F.col(a).alias(f"_o_{a}") for a in attrs])
    diff = batch.select(key, *attrs, ts).join(open_rows, key).where(
        F.coalesce(changed([F.col(a) for a in attrs], [F.col(f"_o_{a}") for a in attrs], null_safe), F.lit(False)))
    return update_from(sat, diff, [key], {TO: minus_one_ms(ts)}, where=_open())


def scd2_insert(sat: DataFrame, batch: DataFrame, key: str, attrs: list[str], ts: str = "update_ts",
                null_safe: bool = False) -> DataFrame:
    """New versions for batch rows whose key has none yet or whose latest version differs."""
    j = _compare(sat, batch, key, attrs, ts)
    return sat.unionByName(_new_versions(j, key, attrs, ts, null_safe).select(sat.columns))


def _new_versions(j: DataFrame, key: str, attrs: list[str], ts: str, null_safe: bool) -> DataFrame:
    chg = F.coalesce(changed([F.col(a) for a in attrs], [F.col(f"_o_{a}") for a in attrs], null_safe), F.lit(False))
    return j.where(chg | F.col("_o_hit").isNull()).select(
        key, *attrs, F.col(ts).alias(FROM), ts_lit(OPEN_TO).alias(TO))


def scd2_apply(sat: DataFrame, batch: DataFrame, key: str, attrs: list[str], ts: str = "update_ts",
               null_safe: bool = False) -> DataFrame:
    """Close + insert in one plan off the same old satellite.

    The batch is first reduced to one row per key.  The insert decision is the
    same before and after the close (closing changes no attributes of the latest
    version), so both steps read the old satellite: one pass closes each open row that
    differs from its key's batch row, one finds the latest versions of the batch's keys.
    """
    b = reduce_batch(batch, key, attrs, ts)
    new = b.select(key, *[F.col(a).alias(f"_n_{a}") for a in attrs], F.col(ts).alias("_n_ts"))
    differs = F.coalesce(changed([F.col(f"_n_{a}") for a in attrs], [F.col(a) for a in attrs], null_safe), F.lit(False))
    ends = _open() & F.col("_n_ts").isNotNull() & differs
    closed = sat.join(new, key, "left").withColumn(TO, F.when(ends, minus_one_ms("_n_ts")).otherwise(F.col(TO)))
    j = _compare(sat, b, key, attrs, ts)
    return closed.select(sat.columns).unionByName(_new_versions(j, key, attrs, ts, null_safe).select(sat.columns))


def scd2_changes(open_rows: DataFrame, batch: DataFrame, key: str, attrs: list[str], ts: str = "update_ts",
                 null_safe: bool = False) -> DataFrame:
    """The versions a batch adds or ends: for a changed key its open version, now closed, and the new one; for a
    key without an open version the new one.

    Reads the open versions only (one a key, as every load leaves them), so a run's cost does not grow with the
    history.  ``scd2_apply`` = the satellite without the open versions ended here, plus these rows.
    """
    b = reduce_batch(batch, key, attrs, ts).select(key, *attrs, ts)
    old = open_rows.where(_open()).select(
        key, *[F.col(a).alias(f"_o_{a}") for a in attrs], F.col(FROM).alias("_o_from"), F.lit(True).alias("_o_hit"))
    j = b.join(old, key, "left")
    chg = F.coalesce(changed([F.col(a) for a in attrs], [F.col(f"_o_{a}") for a in attrs], null_safe), F.lit(False))
    types = {f.name: f.dataType for f in open_rows.schema.fields}

    def version(prefix: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{prefix}{a}").cast(types[a]).alias(a) for a in attrs],
                        start.cast(types[FROM]).alias(FROM), end.cast(types[TO]).alias(TO))

    both = F.array(F.when(chg, version("_o_", F.col("_o_from"), minus_one_ms(ts))),
                   F.when(chg | F.col("_o_hit").isNull(), version("", F.col(ts), ts_lit(OPEN_TO))))
    return j.select(key, F.explode(F.filter(both, lambda v: v.isNotNull())).alias("_v")).select(key, "_v.*")


def scd2_history(updates: DataFrame, key: str, attrs: list[str], ts: str = "update_ts",
                 null_safe: bool = False, per_day: bool = True) -> DataFrame:
    """All versions from a whole history of updates in one job (bulk backfill).

    A daily run sees one update per key and day (the newest staged version),
    so updates are first reduced to the newest per (key, day) -- a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key costs no more than a
    cold one.  After that each key holds at most one row per day, which bounds
    the array of a key below by the number of days, not by the data.

    An update opens a version when it is the key's first or differs from the
    version last opened (a NULL is no change, so after ``a -> NULL -> b`` the
    ``b`` is compared with ``a``); ``active_to`` is the next version's start minus
    1 ms, or the open sentinel.  The versions of a key are a fold over its updates
    in time order.  Equal to ``scd2_apply`` run day by day.  With
    ``per_day=False`` the caller has bounded the updates of a key.
    """
    if per_day:
        updates = latest_per_key(updates.withColumn("_day", F.to_date(ts)), [key, "_day"],
                                 [F.col(ts).desc()] + [F.col(a).desc_nulls_last() for a in attrs])
    one = F.struct(F.col(ts).alias(ts), *[F.col(a).alias(a) for a in attrs])
    by_key = updates.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("_u"))

    def opens(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        differs = F.coalesce(changed([x[a] for a in attrs], [last[a] for a in attrs], null_safe), F.lit(False))
        return F.when((F.size(acc) == 0) | differs, F.concat(acc, F.array(x))).otherwise(acc)

    folded = by_key.select(key, F.aggregate("_u", F.slice("_u", 1, 0), opens).alias("_v"))
    rows = folded.select(key, "_v", F.posexplode("_v").alias("_i", "_x"))
    following = F.try_element_at(F.col("_v"), F.col("_i") + 2)[ts]
    return rows.select(
        key, *[F.col("_x")[a].alias(a) for a in attrs], F.col("_x")[ts].alias(FROM),
        F.coalesce(minus_one_ms(following), ts_lit(OPEN_TO)).alias(TO))
