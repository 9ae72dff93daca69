"""Daily load (staging -> hubs -> link and satellites) and multi-day backfill.

State is a dict ``table name -> DataFrame``.  ``run_day`` returns the new
state lazily; with ``save_root`` every table is written as a new version and
re-read, which both persists the day and cuts the lineage before the next day
(otherwise each day's plan would embed all previous days' plans).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.functions.json import to_document, to_order_document, to_outbox
from vaultspark.functions.time import OPEN_TO, DayLike, day_lit, in_days, previous_day, ts_lit
from vaultspark.operators import quality, replay, scd2, vault
from vaultspark.operators.shred import USER_SPEC, menu_product_keys, shred_documents, shred_menu
from vaultspark.operators.writes import (
    advance_watermark, append_rows, latest_per_key, replace_all, replace_range, replace_slice, replace_window, upsert,
)
from vaultspark.schemas import PARTITIONING, TABLES
from vaultspark.sources.ingest import high_watermark, incremental_scan
from vaultspark.sources.store import (
    BUCKET_COL, DAY_COL, Changes, append_ledger, append_moves, append_rows_to, append_table, bucket_of, day_table, empty_table, load_days,
    load_rows, load_table, moves_table, read_days, read_ledger, replace_days, rewrite_days, save_table, table_buckets,
    table_location, upsert_days, with_buckets,
)

DOCUMENT_COLLECTIONS = {
    "restaurants": "order_system_restaurants",
    "users": "order_system_users",
    "orders": "order_system_orders",
}
HUB_TABLES = {e: f"h_{e}s" for e in ("restaurant", "user", "courier", "order", "product")}
DOCUMENT_WRITERS = {"restaurants": to_document, "users": to_document, "orders": to_order_document}


def empty_state(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: empty_table(spark, name) for name in TABLES}


def _next(day: DayLike) -> str:
    return str(dt.date.fromisoformat(str(day)) + dt.timedelta(days=1))


Persist = Callable[[str, DataFrame], DataFrame]


def _together(steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Independent loads, submitted to Spark side by side."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return dict(zip(steps, pool.map(lambda step: step(), steps.values())))


def _keep(name: str, df: DataFrame) -> DataFrame:
    return df


DAY_TABLES = {"bonus_system_outbox": "event_ts", "couriers_system_deliveries": "order_ts",
              "order_system_orders": "order_date", "s_orders": "order_create_ts",
              "s_restaurants": "active_to", "s_users": "active_to", "s_products": "active_to"}
# Versioned satellites: the open versions are one partition, closed ones lie with the day they ended.
VERSIONED = {"s_restaurants": ("restaurant_id_dwh", ["restaurant_name"]), "s_users": ("user_id_dwh", ["user_name", "user_login"]),
             "s_products": ("product_id_dwh", ["product_name", "product_price", "product_category"])}
OPEN_BUCKETS = 8  # of the open versions of a versioned satellite, and ..
HUB_BUCKETS = 8   # .. of the hubs; a warehouse keeps those it was started with (they are in its ledger)
# Day tables whose day is not one of their columns: the layout day is looked up.
LINK_DAY_TABLE = "l_orders"
MOVES = "order_moves"
# Tables that are saved as whole versions beside the day and append tables.
SNAPSHOTS = ["order_system_restaurants", "order_system_users", "load_watermarks", "bonus_system_users",
             "couriers_system_couriers", "s_couriers"]


Check = Callable[..., DataFrame]


def _checker(on_violation: str | None, rejected: dict[str, DataFrame] | None) -> Check:
    """``check(table, rows, hubs, keys)``: the rows of a load that keep the declared rules of their table."""
    def check(table: str, rows: DataFrame, hubs: dict[str, DataFrame] | None = None, keys: bool = True) -> DataFrame:
        if on_violation is None:
            return rows
        valid, bad = quality.enforce(rows, quality.rules_of(rows, table, hubs, keys), on_violation)
        if rejected is not None:
            rejected[table] = bad
        return valid

    return check


def run_staging(state: dict[str, DataFrame], sources: dict[str, DataFrame], day: DayLike, persist: Persist = _keep,
                day_tables: dict[str, str] | None = None, check: Check = _checker(None, None),
                changes: Changes | None = None) -> dict[str, DataFrame]:
    """Sources -> staging for run date ``day`` (the run starts right after ``day`` ended).

    ``persist(name, df)`` is applied to each table as soon as it is built (the
    watermark advance then reads the persisted stage, not its plan).  With
    ``day_tables`` (table name -> registered day table, see ``store.day_table``)
    the outbox and deliveries are replaced in place, one day partition at a time,
    and the staged orders are upserted rewriting only the business dates touched.
    """
    s = dict(state)
    log = s["load_watermarks"]
    run_end = ts_lit(f"{_next(day)} 00:00:00")
    for coll, table in DOCUMENT_COLLECTIONS.items():
        src = sources[coll].where(F.col("update_ts") < run_end)
        fresh = incremental_scan(src, high_watermark(log, coll))
        staged = check(table, DOCUMENT_WRITERS[coll](fresh), keys=False)  # an upsert keeps one row a key
        if day_tables and table in day_tables:
            s[table] = upsert_days(log.sparkSession, day_tables[table], table, staged, ["object_id"], "update_ts",
                                   DAY_TABLES[table], day_tables.get(MOVES), day, changes)
        else:
            s[table] = persist(table, upsert(s[table], staged, ["object_id"], "update_ts"))
        log = advance_watermark(log, fresh, coll)  # the batch holds every newer row: no scan of the stage
    s["load_watermarks"] = persist("load_watermarks", log)
    if day_tables:
        spark = log.sparkSession
        s["bonus_system_outbox"] = replace_days(spark, day_tables["bonus_system_outbox"], "bonus_system_outbox",
                                                to_outbox(sources["outbox"]), "event_ts", day, changes=changes)
    else:
        s["bonus_system_outbox"] = persist("bonus_system_outbox", replace_slice(
            s["bonus_system_outbox"], to_outbox(sources["outbox"]), "event_ts", day))
    users = check("bonus_system_users", sources["bonus_users"].withColumnsRenamed({"id": "bonus_user_id"}))
    s["bonus_system_users"] = persist("bonus_system_users", replace_all(s["bonus_system_users"], users))
    s["couriers_system_couriers"] = persist("couriers_system_couriers", replace_all(
        s["couriers_system_couriers"], sources["couriers"]))
    window = sources["deliveries"].where(in_days("order_ts", previous_day(day), day))
    deliveries = check("couriers_system_deliveries", window)
    if day_tables:
        s["couriers_system_deliveries"] = replace_days(
            log.sparkSession, day_tables["couriers_system_deliveries"], "couriers_system_deliveries",
            deliveries, "order_ts", previous_day(day), day, changes)
    else:
        s["couriers_system_deliveries"] = persist("couriers_system_deliveries", replace_window(
            s["couriers_system_deliveries"], deliveries, "order_ts", day, 1))
    return s


def _updated_on(stage: DataFrame, day: DayLike) -> DataFrame:
    return stage.where(in_days("update_ts", day))


STAGING_TABLES = ["order_system_restaurants", "order_system_users", "order_system_orders", "load_watermarks",
                  "bonus_system_outbox", "bonus_system_users", "couriers_system_couriers",
                  "couriers_system_deliveries"]
DEPENDENT_TABLES = ["l_orders", "s_restaurants", "s_users", "s_products", "s_couriers", "s_orders"]


def run_hubs(state: dict[str, DataFrame], day: DayLike, key: str = "hash", persist: Persist = _keep,
             tables: dict[str, str] | None = None, check: Check = _checker(None, None),
             changes: Changes | None = None) -> dict[str, DataFrame]:
    """Staging -> the five hubs for run date ``day``.

    With registered append tables (``register_day_tables``) only the new keys are written (``INSERT INTO``).
    """
    s = dict(state)
    stg_r, stg_u, stg_o = s["order_system_restaurants"], s["order_system_users"], s["order_system_orders"]
    batches = {
        "restaurant": (_updated_on(stg_r, day), "object_id"),
        "user": (_updated_on(stg_u, day), "object_id"),
        "courier": (s["couriers_system_couriers"], "_id"),
        "order": (_updated_on(stg_o, day), "object_id"),
        "product": (menu_product_keys(stg_r, day), "product_id"),
    }
    def load(entity: str) -> DataFrame:
        t, (batch, col) = HUB_TABLES[entity], batches[entity]
        added = check(t, vault.hub_additions(s[t], batch, col, entity, key))
        if tables and t in tables:
            return append_rows_to(stg_o.sparkSession, tables[t], t, added, changes)
        return persist(t, append_rows(s[t], added))

    return s | _together({HUB_TABLES[e]: lambda e=e: load(e) for e in batches})


def run_dependents(state: dict[str, DataFrame], day: DayLike, persist: Persist = _keep,
                   day_tables: dict[str, str] | None = None, link_days_back: int = 0, on_violation: str | None = None,
                   rejected: dict[str, DataFrame] | None = None, changes: Changes | None = None) -> dict[str, DataFrame]:
    """Staging + hubs -> link and satellites for run date ``day`` (independent of each other).

    ``link_days_back`` widens the link's window of business days, for orders staged after their day.

    With a day table for the link or the order satellite (partitioned by the order's day), only the partitions of
    the window's days, and of the days that the feed of moved orders names for the window's orders, are read and
    rewritten; with one for a versioned satellite, only the buckets of open versions that hold the batch's keys are read, and
    those whose versions change and the days on which versions end are rewritten.

    ``on_violation`` applies the declared rules, references to the hubs included, to the rows each load adds: ``"split"``
    leaves bad rows out and puts them, with the rules each breaks, into ``rejected[table]``; ``"fail"`` raises; None
    (default) checks nothing.
    """
    check = _checker(on_violation, rejected)

    def checked(table: str, rows: DataFrame) -> DataFrame:
        return check(table, rows, {t: s[t] for t in HUB_TABLES.values()})

    s, tables = dict(state), day_tables or {}
    stg_r, stg_u, stg_o = s["order_system_restaurants"], s["order_system_users"], s["order_system_orders"]
    spark, deliveries = stg_o.sparkSession, s["couriers_system_deliveries"]
    hubs = {e: s[t] for e, t in HUB_TABLES.items()}

    def orders(table: str, load: tuple[DataFrame, DataFrame], part: str, days_back: int) -> DataFrame:
        dropped, rows = load
        rows = checked(table, rows)
        if table in tables:
            held = days_of_orders(stg_o, spark.table(tables[MOVES]), day, days_back) if MOVES in tables else None
            return rewrite_days(spark, tables[table], table, dropped, ["order_id_dwh"], rows, part, held, changes)
        return persist(table, vault.apply_changes(s[table], dropped, rows))

    def versions(table: str, batch: DataFrame) -> DataFrame:
        key, attrs = VERSIONED[table]
        batch = checked(table, batch)
        if table not in tables:
            return persist(table, scd2.scd2_apply(s[table], batch, key, attrs))
        buckets, open_day = table_buckets(spark, tables[table]), ts_lit(OPEN_TO).cast("date")
        batch = batch.checkpoint(eager=True)
        hit = [r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect()]  # as many as there are buckets
        seen = spark.table(tables[table]).where((F.col(DAY_COL) == open_day) & F.col(BUCKET_COL).isin(hit))
        rows = with_buckets(scd2.scd2_changes(seen, batch, key, attrs), key, F.col(scd2.TO) == ts_lit(OPEN_TO), buckets)
        rows = rows.checkpoint(eager=True)
        ended = rows.where(F.col(scd2.TO) != ts_lit(OPEN_TO)).select(key, ts_lit(OPEN_TO).alias(scd2.TO))
        held = ended.select(open_day.alias(DAY_COL), bucket_of(key, buckets).alias(BUCKET_COL))
        return rewrite_days(spark, tables[table], table, ended, [key, scd2.TO], rows, scd2.TO, held, changes)

    return s | _together({
        "l_orders": lambda: orders("l_orders", vault.link_changes(
            stg_o, s["bonus_system_outbox"], deliveries, hubs, day, link_days_back), "order_date", link_days_back),
        "s_restaurants": lambda: versions("s_restaurants", restaurant_batch(stg_r, hubs["restaurant"], day)),
        "s_users": lambda: versions("s_users", user_batch(stg_u, hubs["user"], day)),
        "s_products": lambda: versions("s_products", product_batch(stg_r, hubs["product"], day)),
        "s_couriers": lambda: persist("s_couriers", vault.load_full_satellite(
            s["s_couriers"], checked_couriers(s, checked), hubs["courier"])),
        "s_orders": lambda: orders("s_orders", vault.order_satellite_changes(
            stg_o, hubs["order"], deliveries, day, 1), "order_create_ts", 1),
    })


def days_of_orders(stage_orders: DataFrame, moves: DataFrame, day: DayLike, days_back: int) -> DataFrame:
    """The day partitions that may hold rows of the window's orders: the window, and every earlier business date
    of one of its orders.  Only the window of the stage and the feed of moves are read."""
    window = stage_orders.where(F.col("order_date").between(day_lit(previous_day(day, days_back)), day_lit(day)))
    moved = moves.join(window.select("object_id"), "object_id", "left_semi")
    return window.select(F.col("order_date").alias(DAY_COL)).union(moved.select("old_day")).distinct()


def checked_couriers(state: dict[str, DataFrame], checked: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    named = state["couriers_system_couriers"].withColumnRenamed("name", "courier_name")
    return checked("s_couriers", named).withColumnRenamed("courier_name", "name")


def run_vault(state: dict[str, DataFrame], day: DayLike, key: str = "hash") -> dict[str, DataFrame]:
    """Staging -> hubs, then link and satellites, for run date ``day`` (lazy)."""
    return run_dependents(run_hubs(state, day, key), day)


def _saver(root: str | None, metrics: dict[str, int] | None = None, paths: dict[str, str] | None = None) -> Persist:
    if not root:
        return _keep
    return lambda name, df: save_table(df, root, name, PARTITIONING.get(name), metrics, paths)


def restaurant_batch(stage: DataFrame, hub: DataFrame, day: DayLike | None) -> DataFrame:
    docs = shred_documents(stage, {"name": None}, day)
    return docs.join(hub, docs.object_id == hub.restaurant_id_bk).select(
        "restaurant_id_dwh", F.col("name").alias("restaurant_name"), "update_ts")


def user_batch(stage: DataFrame, hub: DataFrame, day: DayLike | None) -> DataFrame:
    docs = shred_documents(stage, USER_SPEC, day)
    return docs.join(hub, docs.object_id == hub.user_id_bk).select(
        "user_id_dwh", F.col("name").alias("user_name"), F.col("login").alias("user_login"), "update_ts")


def product_batch(stage: DataFrame, hub: DataFrame, day: DayLike | None) -> DataFrame:
    items = shred_menu(stage, day)
    return items.join(hub, items.product_id == hub.product_id_bk).select(
        "product_id_dwh", "product_name", "product_price", "product_category", "update_ts")


def register_day_tables(state: dict[str, DataFrame], root: str, load: bool = False, open_buckets: int = OPEN_BUCKETS,
                        hub_buckets: int = HUB_BUCKETS, metrics: dict[str, int] | None = None,
                        ) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Day and append tables under ``root``; returns the state reading from them and the registered names.

    ``load=True`` is the one bulk load: the tables' content becomes the state's rows.  Without it the tables are
    used as they are on disk, also after a restart, and the state's own rows of them are not looked at.
    ``open_buckets`` (of the open versions) and ``hub_buckets`` (of the hubs, clustered by business key) must stay what they
    were at the load.  ``metrics`` gets the rows of each table loaded, as the writes observe them.
    """
    s, changes = dict(state), {}
    spark = s[LINK_DAY_TABLE].sparkSession
    names = {name: day_table(spark, root, name, open_buckets if name in VERSIONED else 0) for name in [*DAY_TABLES, LINK_DAY_TABLE]}
    names |= {t: append_table(spark, root, t, vault.bk(e), hub_buckets) for e, t in HUB_TABLES.items()}  # hubs only grow
    names[MOVES] = moves_table(spark, root)
    if load:
        # The link is laid out by its order's business date (looked up in the staged orders).
        hub = s["h_orders"].select("order_id_dwh", F.col("order_id_bk").alias("object_id"))
        staged = hub.join(s["order_system_orders"].select("object_id", "order_date"), "object_id", "left")
        dated = s[LINK_DAY_TABLE].join(staged, "order_id_dwh", "left")

        def versions(t: str) -> DataFrame:
            key, _ = VERSIONED[t]
            return load_days(spark, names[t], t, with_buckets(s[t], key, F.col(scd2.TO) == ts_lit(OPEN_TO), open_buckets), scd2.TO, changes)

        loads = {t: lambda t=t, ts=ts: load_days(spark, names[t], t, s[t], ts, changes) for t, ts in DAY_TABLES.items() if t not in VERSIONED}
        loads |= {t: lambda t=t: versions(t) for t in VERSIONED}
        loads[LINK_DAY_TABLE] = lambda: load_days(spark, names[LINK_DAY_TABLE], LINK_DAY_TABLE, dated, "order_date", changes)
        loads |= {t: lambda t=t: load_rows(spark, names[t], t, s[t], changes) for t in HUB_TABLES.values()}
        _together(loads)
        # Satellite rows that lie in another day than their order's business date: the order has moved before.
        lies = s["s_orders"].select("order_id_dwh", F.to_date(DAY_TABLES["s_orders"]).alias("old_day")).join(staged, "order_id_dwh")
        moved = lies.where(~F.col("old_day").eqNullSafe(F.col("order_date")))
        append_moves(spark, names[MOVES], moved.select("object_id", "old_day", F.col("order_date").alias("new_day")), None)
    if metrics is not None:
        metrics |= {t: c["added"] for t, c in changes.items()}
    return s | {t: read_days(spark, names[t], t) for t in names if t in TABLES}, names


def run_day(state: dict[str, DataFrame], sources: dict[str, DataFrame], day: DayLike,
            save_root: str | None = None, key: str = "hash",
            metrics: dict[str, int] | None = None, day_tables: dict[str, str] | None = None,
            link_days_back: int = 0, on_violation: str | None = None,
            rejected: dict[str, DataFrame] | None = None, changes: Changes | None = None) -> dict[str, DataFrame]:
    """One daily run: staging, then hubs, then link and satellites.

    With ``save_root`` every table is persisted as soon as it is built, so no
    table is computed twice and every later step starts from written files.
    With ``metrics`` (a dict) the rows of each table after the run are recorded there (see ``metrics_frame``): of tables saved
    as versions as the write observes them, of day and append tables the rows that ``metrics`` has for them (from the load or
    the run before, or the ledger: ``table_rows``) plus those added and less those removed.  ``changes`` gets the rows
    added and removed per day and append table.  With ``day_tables``
    (``register_day_tables``) outbox and deliveries are replaced per day partition.
    ``on_violation`` and ``rejected``: the declared rules, see ``run_dependents``.

    With ``save_root`` and ``day_tables`` the run ends with its rows in the ledger, from which ``load_state`` finds the
    tables again; rows rejected by the rules are saved beside the tables, a version a run.  A run that failed before has no such rows; running the same day from ``load_state`` finishes it, as
    every step gives the same tables when it is repeated.
    """
    paths: dict[str, str] = {}
    persist = _saver(save_root, metrics, paths)
    if on_violation == "split" and rejected is None:
        rejected = {}
    check, changes = _checker(on_violation, rejected), {} if changes is None else changes
    s = run_staging(state, sources, day, persist, day_tables, check, changes)
    s = run_hubs(s, day, key, persist, day_tables, check, changes)
    s = run_dependents(s, day, persist, day_tables, link_days_back, on_violation, rejected, changes)
    if metrics is not None:
        for t in set(day_tables or {}) & set(TABLES):
            was, now = metrics.get(t), changes.get(t, {"added": 0, "removed": 0})
            metrics[t] = s[t].count() if was is None else was + now["added"] - now["removed"]  # counted once, where not known
    if save_root and on_violation == "split":
        rejected |= {t: save_table(bad, save_root, f"rejects/{t}", paths=paths) for t, bad in rejected.items()}
    if save_root and day_tables:
        _finish(s[LINK_DAY_TABLE].sparkSession, save_root, day, paths, day_tables, metrics)
    return s


def _finish(spark: SparkSession, root: str, day: DayLike, paths: dict[str, str], day_tables: dict[str, str],
            metrics: dict[str, int] | None = None) -> None:
    """The ledger rows of a run: each table's kind, place and, where counted, rows."""
    run, date, counts = time.time_ns(), dt.date.fromisoformat(str(day)), metrics or {}
    rows = [(run, date, t, "version" if t in TABLES else "rejects", path, None, counts.get(t)) for t, path in paths.items()]
    for t, table in day_tables.items():
        rows.append((run, date, t, "table", table_location(spark, table), table_buckets(spark, table), counts.get(t)))
    append_ledger(spark, root, rows)


def load_state(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], dict[str, str], dt.date | None]:
    """``(state, day tables, day of the last finished run)`` from what lies under ``root`` alone, as in a new session.

    Tables that are saved as versions are those of the last finished run; day and append tables are as they are on
    disk, which may be ahead of it by a run that failed.  Without a finished run the state is empty and the day None.
    """
    rows = read_ledger(spark, root).collect()  # one row a table and run
    last = max((r["run_id"] for r in rows), default=None)
    rows = [r for r in rows if r["run_id"] == last]
    if not rows:
        return empty_state(spark), {}, None
    state = empty_state(spark)
    state |= {r["table_name"]: load_table(spark, r["path"], TABLES[r["table_name"]]) for r in rows if r["kind"] == "version"}
    at = {r["path"].rsplit("/", 1)[0] for r in rows if r["kind"] == "table"}
    buckets = {r["table_name"]: r["buckets"] for r in rows}
    state, names = register_day_tables(state, at.pop(), False, buckets["s_users"], buckets["h_users"])
    return state, names, rows[0]["run_day"]


def table_rows(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows of each table after the last finished run, as its ledger has them; the ``metrics`` of the run that follows."""
    rows = read_ledger(spark, root).collect()
    last = max((r["run_id"] for r in rows), default=None)
    return {r["table_name"]: r["rows"] for r in rows if r["run_id"] == last and r["rows"] is not None and r["table_name"] in TABLES}


def start(spark: SparkSession, sources: dict[str, DataFrame], root: str, lo: DayLike, hi: DayLike | None = None,
          key: str = "hash", open_buckets: int = OPEN_BUCKETS, hub_buckets: int = HUB_BUCKETS,
          ) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The first load of a warehouse under ``root``: the bulk backfill of ``lo .. hi`` into day and append tables (empty
    tables without ``hi``), entered in the ledger."""
    state = empty_state(spark) if hi is None else backfill(spark, sources, lo, hi, key, f"{root}/bulk")
    paths: dict[str, str] = {}
    metrics: dict[str, int] = {}
    persist = _saver(root, metrics, paths)
    state |= {t: persist(t, state[t]) for t in SNAPSHOTS}
    state, names = register_day_tables(state, root, True, open_buckets, hub_buckets, metrics)
    _finish(spark, root, hi or previous_day(lo), paths, names, metrics)
    return state, names


def _newest_of_day(documents: DataFrame) -> DataFrame:
    """The version a daily run would see: the newest of each object and day."""
    newest = latest_per_key(documents.withColumn("_day", F.to_date("update_ts")), ["object_id", "_day"],
                            [F.col("update_ts").desc(), F.col("object_value").desc()])
    return newest.drop("_day")


def backfill(spark: SparkSession, sources: dict[str, DataFrame], lo: DayLike, hi: DayLike,
             key: str = "hash", save_root: str | None = None, link_days_back: int = 0) -> dict[str, DataFrame]:
    """State after daily runs ``lo..hi``, built for all days at once (lazy).

    Hubs and satellites are built from the newest source version of each object
    and day in the range (SCD2 through ``scd2_history``); the link and the order
    satellite from the version with which each order was last loaded, joined with what had been staged by that
    run (``operators.replay``).  Equal to ``run_days(lo, hi)``, also for orders that change after their business day.
    With ``save_root`` staging, then hubs, then the rest are persisted as they are built, and before them what several of
    them read: the documents up to ``hi`` (so the sources are read once) and the orders' versions by run.
    ``link_days_back``: see ``run_dependents``.
    """
    persist = _saver(save_root)
    shared = (lambda name, df: save_table(df, save_root, f"shared/{name}")) if save_root else _keep
    s = empty_state(spark)
    lo_d = dt.date.fromisoformat(str(lo))
    run_end = ts_lit(f"{_next(hi)} 00:00:00")
    versions: dict[str, DataFrame] = {}
    logs = []
    for coll, table in DOCUMENT_COLLECTIONS.items():
        src = shared(table, DOCUMENT_WRITERS[coll](sources[coll].where(F.col("update_ts") < run_end)))
        s[table] = upsert(s[table], src, ["object_id"], "update_ts")
        seen = src.where(in_days("update_ts", lo, hi))
        versions[coll] = seen if coll == "orders" else _newest_of_day(seen)
        logs.append(src.agg(F.max("update_ts").alias("update_ts"))
                    .where(F.col("update_ts").isNotNull()).select(F.lit(coll).alias("table_name"), "update_ts"))
    log = logs[0]
    for part in logs[1:]:
        log = log.unionByName(part)
    s["load_watermarks"] = log
    s["bonus_system_outbox"] = replace_range(s["bonus_system_outbox"], to_outbox(sources["outbox"]), "event_ts", lo, hi)
    s["bonus_system_users"] = replace_all(
        s["bonus_system_users"], sources["bonus_users"].withColumnsRenamed({"id": "bonus_user_id"}))
    s["couriers_system_couriers"] = replace_all(s["couriers_system_couriers"], sources["couriers"])
    s["couriers_system_deliveries"] = replace_range(
        s["couriers_system_deliveries"], sources["deliveries"], "order_ts", str(lo_d - dt.timedelta(days=1)), hi)
    for t in STAGING_TABLES:
        s[t] = persist(t, s[t].select(*TABLES[t].fieldNames()))

    vr, vu, vo = versions["restaurants"], versions["users"], versions["orders"]
    s["h_restaurants"] = vault.load_hub(s["h_restaurants"], vr, "object_id", "restaurant", key)
    s["h_users"] = vault.load_hub(s["h_users"], vu, "object_id", "user", key)
    s["h_couriers"] = vault.load_hub(s["h_couriers"], s["couriers_system_couriers"], "_id", "courier", key)
    s["h_orders"] = vault.load_hub(s["h_orders"], vo, "object_id", "order", key)
    s["h_products"] = vault.load_hub(s["h_products"], menu_product_keys(vr, None), "product_id", "product", key)
    for t in HUB_TABLES.values():
        s[t] = persist(t, s[t])
    hubs = {e: s[t] for e, t in HUB_TABLES.items()}

    menus = shred_menu(vr, None)
    dated = hubs | {e: replay.dated_hub(hubs[e], e, replay.first_days(keys, col)) for e, keys, col in (
        ("restaurant", vr, "object_id"), ("user", vu, "object_id"), ("product", menus, "product_id"))}
    deliveries = s["couriers_system_deliveries"]
    by_run = shared("orders_by_run", replay.run_versions(vo, hi))
    s["l_orders"] = replay.replay_link(shared("orders_linked", replay.loads_of(by_run, lo, hi, link_days_back)),
                                       s["bonus_system_outbox"], deliveries, dated, link_days_back)
    s["s_restaurants"] = scd2.scd2_history(restaurant_batch(vr, hubs["restaurant"], None),
                                           "restaurant_id_dwh", ["restaurant_name"])
    s["s_users"] = scd2.scd2_history(user_batch(vu, hubs["user"], None), "user_id_dwh", ["user_name", "user_login"])
    s["s_products"] = scd2.scd2_history(product_batch(vr, hubs["product"], None), "product_id_dwh",
                                        ["product_name", "product_price", "product_category"])
    s["s_couriers"] = vault.load_full_satellite(s["s_couriers"], s["couriers_system_couriers"], hubs["courier"])
    s["s_orders"] = replay.replay_order_satellite(replay.loads_of(by_run, lo, hi, 1), deliveries, hubs["order"])
    for t in DEPENDENT_TABLES:
        s[t] = persist(t, s[t].select(*TABLES[t].fieldNames()))
    return s


def run_days(state: dict[str, DataFrame], sources: dict[str, DataFrame], lo: DayLike, hi: DayLike,
             save_root: str, key: str = "hash", **options) -> dict[str, DataFrame]:
    """Backfill: one run per day from ``lo`` to ``hi``, each persisted before the next; ``options`` as of ``run_day``
    (day tables, rules, the link's window)."""
    day = dt.date.fromisoformat(str(lo))
    end = dt.date.fromisoformat(str(hi))
    while day <= end:
        state = run_day(state, sources, day, save_root, key, **options)
        day += dt.timedelta(days=1)
    return state


def resume_days(spark: SparkSession, sources: dict[str, DataFrame], root: str, lo: DayLike, hi: DayLike, key: str = "hash",
                chunk: int = 0, open_buckets: int = OPEN_BUCKETS, hub_buckets: int = HUB_BUCKETS, **options) -> dict[str, DataFrame]:
    """The warehouse under ``root`` after the runs ``lo .. hi``, going on after the last finished run that its ledger names.

    Called again after a failure, it repeats the run that was broken and skips those before it.  A first call loads the
    first ``chunk`` days in bulk, then runs day by day.
    """
    state, names, last = load_state(spark, root)
    if last is None:
        first = previous_day(lo, 1 - chunk) if chunk else None
        end = min(first, dt.date.fromisoformat(str(hi))) if first else None
        state, names = start(spark, sources, root, lo, end, key, open_buckets, hub_buckets)
        last = end or previous_day(lo)
    return run_days(state, sources, last + dt.timedelta(days=1), hi, root, key, day_tables=names, metrics=table_rows(spark, root), **options)


def metrics_frame(spark: SparkSession, metrics: dict[str, int], day: DayLike) -> DataFrame:
    """Observed row counts of a run as a small DataFrame ``(run_date, table_name, rows)``."""
    return spark.createDataFrame([(str(day), k, v) for k, v in sorted(metrics.items())],
                                 "run_date string, table_name string, rows bigint")


def load_metrics(steps: dict[str, DataFrame]) -> DataFrame:
    """Row count of each step as one small DataFrame ``(step, rows)`` (one job)."""
    parts = [df.select(F.lit(name).alias("step"), F.count(F.lit(1)).alias("rows")) for name, df in steps.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
