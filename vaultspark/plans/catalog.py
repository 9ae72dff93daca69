"""Registered queries: one per operator of the inventory, each with a DuckDB oracle.

Every query reads the driver tables at ``sf_dir`` (through ``World``), runs
over whole tables, and returns a lazy DataFrame.  Column names and types match
the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.functions.json import json_field, to_document, to_order_document
from vaultspark.functions.keys import hash_key
from vaultspark.functions.predicates import changed
from vaultspark.functions.time import OPEN_TO, in_days, local_day, minus_one_ms, ts_lit
from vaultspark.operators import quality as Q
from vaultspark.operators import scd2, shred, vault, writes
from vaultspark.plans import pipeline
from vaultspark.plans.oracle_sql import D, D1, OPEN, scd2_two_days, sql
from vaultspark.plans.world import World
from vaultspark.session import shared_dir
from vaultspark.sources import fixtures as fx
from vaultspark.sources import ingest
from vaultspark.sources.store import conform, day_table, load_days, save_table, upsert_days
from vaultspark.schemas import STAGING

DAY = fx.TEST_DAY
PREV = "2024-01-04"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def deco(fn: Callable[[World], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(World(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _order_ids(df: DataFrame, col: str = "object_id") -> DataFrame:
    return df.select(F.col(col).alias("object_id"), "update_ts")


# ======================================================================== scans

def watermark_log(w: World) -> DataFrame:
    """Watermark log as left by the daily staging loads: orders loaded through D-1,
    restaurants v1 and v2, users v1 (one row per load with the stage's maximum)."""
    per_day = (w.stg_orders.where(F.col("update_ts") < ts_lit(f"{DAY} 00:00:00"))
               .groupBy(F.to_date("update_ts")).agg(F.max("update_ts").alias("update_ts")))
    parts = [per_day.select(F.lit("orders").alias("table_name"), "update_ts")]
    for name, stg in (("restaurants", w.stg_restaurants_v1), ("restaurants", w.stg_restaurants_v2),
                      ("users", w.stg_users_v1)):
        parts.append(stg.select(F.lit(name).alias("table_name"), F.max("update_ts").alias("update_ts")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("high_watermark", sql(
    "SELECT n.table_name, coalesce(max(l.update_ts), TIMESTAMP '1900-01-01') AS high_watermark "
    "FROM (VALUES ('orders'), ('restaurants'), ('users'), ('couriers')) n(table_name) "
    "LEFT JOIN wlog l ON l.table_name = n.table_name GROUP BY n.table_name", "wlog"))
def q_high_watermark(w: World) -> DataFrame:
    return ingest.high_watermarks(watermark_log(w), ["orders", "restaurants", "users", "couriers"])


@query("incremental_scan", sql(
    "SELECT CAST(o_orderkey AS VARCHAR) AS object_id, odate AS update_ts, o_orderstatus AS final_status FROM ord "
    "WHERE odate > (SELECT max(update_ts) FROM wlog WHERE table_name = 'orders')", "wlog"))
def q_incremental_scan(w: World) -> DataFrame:
    wm = ingest.high_watermark(watermark_log(w), "orders")
    return ingest.incremental_scan(w.orders_source, wm).select(
        F.col("_id").alias("object_id"), "update_ts", "final_status")


@query("date_slice",
       f"SELECT event_type, props AS event_value, ts AS event_ts FROM events WHERE CAST(ts AS DATE) = {D}")
def q_date_slice(w: World) -> DataFrame:
    return ingest.date_slice(fx.other_events(w.t), "event_ts", DAY)


@query("full_scan_rename",
       "SELECT CAST(c_custkey AS INTEGER) AS bonus_user_id, CAST(c_custkey AS VARCHAR) AS order_user_id FROM customer")
def q_full_scan_rename(w: World) -> DataFrame:
    return ingest.full_scan(fx.bonus_users(w.t), {"id": "bonus_user_id"})


@query("landed_json", "SELECT CAST(n_nationkey AS VARCHAR) AS _id, n_name AS name FROM nation")
def q_landed_json(w: World) -> DataFrame:
    # Written with the fields in another order than the declared schema: bound by name.
    path = ingest.land_json(w.couriers.select("name", "_id"), shared_dir(w.spark, "landed-couriers"))
    return ingest.read_landed_json(w.spark, path, STAGING["couriers_system_couriers"])


@query("landed_pages", sql(
    f"SELECT * FROM deliv WHERE CAST(order_ts AS DATE) BETWEEN {D1} AND {D}", "deliv"))
def q_landed_pages(w: World) -> DataFrame:
    pages = w.deliveries.repartitionByRange("order_ts")
    path = ingest.land_json(pages, shared_dir(w.spark, "landed-deliveries"), records_per_file=500)
    return ingest.read_landed_pages(w.spark, path, STAGING["couriers_system_deliveries"], "order_ts", DAY, 1)


@query("update_day_slice", sql(
    f"SELECT CAST(o_orderkey AS VARCHAR) AS object_id, odate AS update_ts FROM ord WHERE CAST(odate AS DATE) = {D}",
    "ord"))
def q_update_day_slice(w: World) -> DataFrame:
    return _order_ids(ingest.date_slice(w.stg_orders, "update_ts", DAY))


@query("business_day_slice", sql(
    f"SELECT CAST(o_orderkey AS VARCHAR) AS object_id, CAST(odate AS DATE) AS order_date FROM ord "
    f"WHERE CAST(odate AS DATE) = {D}", "ord"))
def q_business_day_slice(w: World) -> DataFrame:
    s = ingest.business_day_slice(w.stg_orders, DAY)
    return s.select("object_id", ingest.business_day(s).alias("order_date"))


@query("window_slice", sql(f"SELECT * FROM deliv WHERE CAST(order_ts AS DATE) BETWEEN {D1} AND {D}", "deliv"))
def q_window_slice(w: World) -> DataFrame:
    return ingest.window_slice(w.deliveries, "order_ts", DAY, 1)


@query("event_slice", sql(
    f"SELECT event_type, event_ts, order_id FROM outbox WHERE event_type = 'bonus_transaction' "
    f"AND CAST(event_ts AS DATE) = {D}", "outbox"))
def q_event_slice(w: World) -> DataFrame:
    s = ingest.event_slice(w.outbox, "bonus_transaction", DAY)
    return s.select("event_type", "event_ts", json_field("event_value", "$.order_id").alias("order_id"))


@query("read_source", "SELECT * FROM orders")
def q_read_source(w: World) -> DataFrame:
    return ingest.read_source(w.spark, "parquet", f"{w.sf_dir}/orders.parquet")


# ======================================================================== write modes

@query("upsert_documents", sql(
    "SELECT a.bk AS object_id, coalesce(b.update_ts, a.update_ts) AS update_ts, coalesce(b.name, a.name) AS name, "
    "coalesce(b.login, a.login) AS login FROM users1 a LEFT JOIN users2 b ON a.bk = b.bk", "users1", "users2"))
def q_upsert_documents(w: World) -> DataFrame:
    # The batch re-sends the old version of every touched user next to its new one: newest wins.
    resent = w.stg_users_v1.join(w.stg_users_v2.select("object_id"), "object_id", "left_semi")
    out = writes.upsert(w.stg_users_v1, resent.unionByName(w.stg_users_v2), ["object_id"], "update_ts")
    return out.select("object_id", "update_ts", json_field("object_value", "$.name").alias("name"),
                      json_field("object_value", "$.login").alias("login"))


@query("upsert_documents_by_day", (
    "SELECT CAST(o_orderkey AS VARCHAR) AS object_id, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS update_ts, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN "
    "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) END "
    "WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS order_date FROM orders"))
def q_upsert_documents_by_day(w: World) -> DataFrame:
    """All orders in a table partitioned by business date, some undated; all urgent ones move, to a date or to none."""
    src = w.spark.read.parquet(f"{w.sf_dir}/orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    month = F.trunc("o_orderdate", "month")
    staged = src.select(
        F.col("o_orderkey").cast("string").alias("object_id"), F.lit("{}").alias("object_value"),
        F.col("o_orderdate").alias("update_ts"),
        F.when(F.col("o_orderstatus") == "P", None).otherwise(month).cast("date").alias("order_date"))
    moved = src.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").cast("string").alias("object_id"), F.lit("{}").alias("object_value"),
        F.expr("o_orderdate + INTERVAL 1 DAY").alias("update_ts"),
        F.when(F.col("o_orderstatus") == "F", None).otherwise(F.add_months(month, 1)).cast("date").alias("order_date"))
    name = "order_system_orders"
    table = day_table(w.spark, shared_dir(w.spark, "orders-by-day"), name)
    load_days(w.spark, table, name, staged, "order_date")
    return upsert_days(w.spark, table, name, moved, ["object_id"], "update_ts", "order_date").select(
        "object_id", "update_ts", "order_date")


@query("advance_watermark", sql(
    "SELECT table_name, update_ts FROM wlog UNION ALL SELECT 'orders', max(odate) FROM ord", "wlog"))
def q_advance_watermark(w: World) -> DataFrame:
    log = watermark_log(w)
    log = writes.advance_watermark(log, w.stg_orders, "orders")     # newer maximum: appended
    log = writes.advance_watermark(log, w.stg_users_v1, "users")    # same maximum: nothing appended
    return log


@query("replace_day", sql(
    f"SELECT event_type, event_ts, order_id FROM outbox WHERE CAST(event_ts AS DATE) <> {D} "
    f"UNION ALL SELECT event_type, ts, CAST(NULL AS VARCHAR) FROM events WHERE CAST(ts AS DATE) = {D}", "outbox"))
def q_replace_day(w: World) -> DataFrame:
    out = writes.replace_slice(w.outbox, fx.other_events(w.t), "event_ts", DAY)
    return out.select("event_type", "event_ts", json_field("event_value", "$.order_id").alias("order_id"))


@query("replace_all", "SELECT CAST(n_nationkey AS VARCHAR) AS _id, n_name AS name FROM nation")
def q_replace_all(w: World) -> DataFrame:
    stale = w.couriers.unionByName(w.couriers)  # a list loaded twice
    return writes.replace_all(stale, w.couriers)


@query("replace_range", sql("SELECT * FROM deliv", "deliv"))
def q_replace_range(w: World) -> DataFrame:
    # The two-day window was appended twice by a run that did not delete first.
    doubled = w.deliveries.unionByName(ingest.window_slice(w.deliveries, "order_ts", DAY, 1))
    return writes.replace_range(doubled, w.deliveries, "order_ts", PREV, DAY)


@query("insert_absent", sql(
    "SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS order_id_dwh, CAST(o_orderkey AS VARCHAR) AS order_id_bk "
    f"FROM ord WHERE CAST(odate AS DATE) <= {D}", "ord"))
def q_insert_absent(w: World) -> DataFrame:
    hub = w.order_hub(fx.FIRST_DAY, PREV)
    batch = w.stg_orders.where(in_days("update_ts", PREV, DAY))
    rows = batch.select(hash_key("object_id").alias("order_id_dwh"), F.col("object_id").alias("order_id_bk"))
    return writes.insert_absent(hub, rows.unionByName(rows), ["order_id_bk"])


@query("delete_keys", sql(f"SELECT * FROM deliv WHERE CAST(order_ts AS DATE) <> {D}", "deliv"))
def q_delete_keys(w: World) -> DataFrame:
    day_orders = ingest.business_day_slice(w.stg_orders, DAY).select(F.col("object_id").alias("order_id"))
    return writes.delete_keys(w.deliveries, day_orders, ["order_id"])


def persisted(w: World, df: DataFrame, name: str) -> DataFrame:
    """A day's table as the daily run leaves it: written, then read back (the next day's
    plan starts from files instead of embedding this day's plan)."""
    return save_table(df, shared_dir(w.spark, "days"), name)


def users_sat_v1(w: World) -> DataFrame:
    batch = pipeline.user_batch(w.stg_users_v1, w.user_hub, fx.FIRST_DAY)
    return persisted(w, scd2.scd2_apply(w.empty("s_users"), batch, "user_id_dwh", ["user_name", "user_login"]),
                     "s_users")


def users_batch_v2(w: World) -> DataFrame:
    return pipeline.user_batch(w.stg_users_v2, w.user_hub, fx.SECOND_DAY)


@query("update_from", sql(
    "SELECT sha256(a.bk) AS user_id_dwh, a.name AS user_name, a.login AS user_login, a.update_ts AS active_from, "
    f"CASE WHEN b.bk IS NULL THEN {OPEN} ELSE b.update_ts - INTERVAL 1 MILLISECOND END AS active_to "
    "FROM users1 a LEFT JOIN users2 b ON a.bk = b.bk", "users1", "users2"))
def q_update_from(w: World) -> DataFrame:
    sat = users_sat_v1(w)
    upd = users_batch_v2(w)
    return writes.update_from(sat, upd, ["user_id_dwh"], {"active_to": minus_one_ms("update_ts")},
                              where=F.col("active_to") == ts_lit(OPEN_TO))


@query("append_rows", sql("SELECT * FROM outbox", "outbox"))
def q_append_rows(w: World) -> DataFrame:
    out = writes.append_rows(fx.other_events(w.t), fx.bonus_events(w.t))
    return out.select("event_type", "event_ts", json_field("event_value", "$.order_id").alias("order_id"))


@query("table_roundtrip", sql("SELECT * FROM deliv", "deliv"))
def q_table_roundtrip(w: World) -> DataFrame:
    name = "couriers_system_deliveries"
    return save_table(conform(w.deliveries, name), shared_dir(w.spark, "store"), name)


@query("document_text", sql(
    "SELECT CAST(o.o_orderkey AS VARCHAR) AS object_id, o.odate AS update_ts, "
    "strftime(o.odate, '%Y-%m-%d %H:%M:%S.%f') AS date_text, o.o_orderstatus AS final_status, "
    "CAST(r.rkey AS VARCHAR) AS restaurant_id, CAST(o.o_custkey AS VARCHAR) AS user_id, "
    "CAST(coalesce(n.n, 0) AS INTEGER) AS n_items FROM ord o LEFT JOIN orest r ON r.l_orderkey = o.o_orderkey "
    "LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM items GROUP BY l_orderkey) n ON n.l_orderkey = o.o_orderkey",
    "ord", "orest", "items"))
def q_document_text(w: World) -> DataFrame:
    v = "object_value"
    return w.stg_orders.select(
        "object_id", "update_ts",
        json_field(v, "$.date").alias("date_text"),
        json_field(v, "$.final_status").alias("final_status"),
        json_field(v, "$.restaurant.id").alias("restaurant_id"),
        json_field(v, "$.user.id").alias("user_id"),
        F.json_array_length(json_field(v, "$.order_items")).alias("n_items"),
    )


@query("json_fields", sql(
    "SELECT CAST(o.o_orderkey AS VARCHAR) AS object_id, o.o_orderstatus AS final_status, "
    "CAST(r.rkey AS VARCHAR) AS restaurant_id, CAST(o.o_custkey AS VARCHAR) AS user_id, o.odate AS order_ts "
    "FROM ord o LEFT JOIN orest r ON r.l_orderkey = o.o_orderkey", "ord", "orest"))
def q_json_fields(w: World) -> DataFrame:
    return shred.parsed_orders(w.stg_orders).select("object_id", "final_status", "restaurant_id", "user_id", "order_ts")


@query("local_day",
       "SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Moscow' AS DATE) AS local_day FROM events")
def q_local_day(w: World) -> DataFrame:
    return w.t("events").select("event_id", local_day("ts").alias("local_day"))


# ======================================================================== hubs

@query("anti_join_new_keys", sql(
    f"SELECT CAST(o_orderkey AS VARCHAR) AS order_id_bk FROM ord WHERE CAST(odate AS DATE) = {D}", "ord"))
def q_anti_join_new_keys(w: World) -> DataFrame:
    hub = w.order_hub(fx.FIRST_DAY, PREV)
    batch = w.stg_orders.where(in_days("update_ts", PREV, DAY))
    return vault.new_keys(hub, batch, "object_id", "order")


def _hub_sql(bk_expr: str, table: str, where: str = "") -> str:
    return (f"SELECT DISTINCT sha256(CAST({bk_expr} AS VARCHAR)) AS {{e}}_id_dwh, CAST({bk_expr} AS VARCHAR) AS "
            f"{{e}}_id_bk FROM {table} {where}")


@query("hub_restaurants", _hub_sql("s_suppkey", "supplier").format(e="restaurant"))
def q_hub_restaurants(w: World) -> DataFrame:
    h = vault.load_hub(w.empty("h_restaurants"), ingest.date_slice(w.stg_restaurants_v1, "update_ts", fx.FIRST_DAY),
                       "object_id", "restaurant")
    return vault.load_hub(h, ingest.date_slice(w.stg_restaurants_v2, "update_ts", fx.SECOND_DAY),
                          "object_id", "restaurant")


@query("hub_users", _hub_sql("c_custkey", "customer").format(e="user"))
def q_hub_users(w: World) -> DataFrame:
    h = vault.load_hub(w.empty("h_users"), ingest.date_slice(w.stg_users_v1, "update_ts", fx.FIRST_DAY),
                       "object_id", "user")
    return vault.load_hub(h, ingest.date_slice(w.stg_users_v2, "update_ts", fx.SECOND_DAY), "object_id", "user")


@query("hub_couriers", _hub_sql("n_nationkey", "nation").format(e="courier"))
def q_hub_couriers(w: World) -> DataFrame:
    h = vault.load_hub(w.empty("h_couriers"), w.couriers, "_id", "courier")
    return vault.load_hub(h, w.couriers, "_id", "courier")  # full list every run: nothing new


@query("hub_orders", sql(
    _hub_sql("o_orderkey", "ord", f"WHERE CAST(odate AS DATE) BETWEEN {D1} AND {D}").format(e="order"), "ord"))
def q_hub_orders(w: World) -> DataFrame:
    h = vault.load_hub(w.empty("h_orders"), ingest.date_slice(w.stg_orders, "update_ts", PREV), "object_id", "order")
    return vault.load_hub(h, ingest.date_slice(w.stg_orders, "update_ts", DAY), "object_id", "order")


@query("hub_products", _hub_sql("p_partkey", "part").format(e="product"))
def q_hub_products(w: World) -> DataFrame:
    h = vault.load_hub(w.empty("h_products"), shred.menu_product_keys(w.stg_restaurants_v1, fx.FIRST_DAY),
                       "product_id", "product")
    return vault.load_hub(h, shred.menu_product_keys(w.stg_restaurants_v2, fx.SECOND_DAY), "product_id", "product")


@query("hub_sequence_keys", sql(
    f"SELECT CAST(row_number() OVER (ORDER BY bk) AS BIGINT) AS order_id_dwh, bk AS order_id_bk FROM "
    f"(SELECT CAST(o_orderkey AS VARCHAR) AS bk FROM ord WHERE CAST(odate AS DATE) = {D1}) "
    f"UNION ALL SELECT CAST((SELECT count(*) FROM ord WHERE CAST(odate AS DATE) = {D1}) "
    f"+ row_number() OVER (ORDER BY bk) AS BIGINT), bk FROM "
    f"(SELECT CAST(o_orderkey AS VARCHAR) AS bk FROM ord WHERE CAST(odate AS DATE) = {D})", "ord"))
def q_hub_sequence_keys(w: World) -> DataFrame:
    empty = w.spark.createDataFrame([], "order_id_dwh bigint, order_id_bk string")
    h = vault.load_hub(empty, ingest.date_slice(w.stg_orders, "update_ts", PREV), "object_id", "order", "sequence")
    return vault.load_hub(h, ingest.date_slice(w.stg_orders, "update_ts", DAY), "object_id", "order", "sequence")


# ======================================================================== shredding

@query("order_items", sql(
    "SELECT CAST(i.l_orderkey AS VARCHAR) AS order_id, CAST(i.l_partkey AS VARCHAR) AS product_id, i.quantity "
    f"FROM items i JOIN ord o ON o.o_orderkey = i.l_orderkey WHERE CAST(o.odate AS DATE) = {D}", "ord", "items"))
def q_order_items(w: World) -> DataFrame:
    return shred.shred_order_items(w.stg_orders, DAY)


@query("order_bonuses", sql(
    "SELECT CAST(b.l_orderkey AS VARCHAR) AS order_id, CAST(b.l_partkey AS VARCHAR) AS product_id, "
    f"b.bonus_payment, b.bonus_grant FROM bon b JOIN ord o ON o.o_orderkey = b.l_orderkey "
    f"WHERE CAST(o.odate AS DATE) = {D}", "ord", "bon"))
def q_order_bonuses(w: World) -> DataFrame:
    return shred.shred_bonuses(w.outbox, DAY)


@query("menu_products", sql(
    "SELECT bk AS product_id, name AS product_name, price AS product_price, category AS product_category, "
    "update_ts FROM prod1", "prod1"))
def q_menu_products(w: World) -> DataFrame:
    return shred.shred_menu(w.stg_restaurants_v1, fx.FIRST_DAY)


# ======================================================================== link (V7, B2)

LINK_COLS = ("order_id_dwh, restaurant_id_dwh, user_id_dwh, courier_id_dwh, product_id_dwh, quantity, "
             "bonus_payment, bonus_grant")


@query("link_orders_day", sql(f"SELECT {LINK_COLS} FROM link WHERE _day = {D}", "link"))
def q_link_orders_day(w: World) -> DataFrame:
    return vault.load_link(w.empty("l_orders"), w.stg_orders, w.outbox, w.deliveries, w.hubs_for_day(DAY), DAY)


@query("link_orders_all", sql(f"SELECT {LINK_COLS} FROM link", "link"))
def q_link_orders_all(w: World) -> DataFrame:
    return vault.load_link(w.empty("l_orders"), w.stg_orders, w.outbox, w.deliveries, w.hubs(w.order_hub()), None)


@query("rerun_day", sql(f"SELECT {LINK_COLS} FROM link WHERE _day = {D}", "link"))
def q_rerun_day(w: World) -> DataFrame:
    hubs = w.hubs_for_day(DAY)
    once = vault.load_link(w.empty("l_orders"), w.stg_orders, w.outbox, w.deliveries, hubs, DAY)
    return vault.load_link(once, w.stg_orders, w.outbox, w.deliveries, hubs, DAY)


# ======================================================================== SCD2

USERS_SAT = scd2_two_days("users1", "users2", "user_id_dwh", [("name", "user_name"), ("login", "user_login")])


def users_sat_v2(w: World) -> DataFrame:
    return scd2.scd2_apply(users_sat_v1(w), users_batch_v2(w), "user_id_dwh", ["user_name", "user_login"])


@query("latest_per_key", f"SELECT user_id_dwh, user_name, user_login, active_from FROM ({USERS_SAT}) "
                         f"WHERE active_to = {OPEN}")
def q_latest_per_key(w: World) -> DataFrame:
    return scd2.latest_versions(users_sat_v2(w), "user_id_dwh").select(
        "user_id_dwh", "user_name", "user_login", "active_from")


@query("change_predicate", sql(
    "SELECT sha256(b.bk) AS user_id_dwh, (a.name <> b.name OR a.login <> b.login) AS is_changed, "
    "(a.bk IS NULL) AS is_new FROM users2 b LEFT JOIN users1 a ON a.bk = b.bk", "users1", "users2"))
def q_change_predicate(w: World) -> DataFrame:
    latest = scd2.latest_versions(users_sat_v1(w), "user_id_dwh").select(
        "user_id_dwh", F.col("user_name").alias("o_name"), F.col("user_login").alias("o_login"),
        F.lit(True).alias("o_hit"))
    j = users_batch_v2(w).join(latest, "user_id_dwh", "left")
    return j.select("user_id_dwh",
                    changed([F.col("user_name"), F.col("user_login")], [F.col("o_name"), F.col("o_login")])
                    .alias("is_changed"),
                    F.col("o_hit").isNull().alias("is_new"))


@query("scd2_close", sql(
    "SELECT sha256(a.bk) AS user_id_dwh, a.name AS user_name, a.login AS user_login, a.update_ts AS active_from, "
    f"CASE WHEN b.bk IS NOT NULL AND (a.name <> b.name OR a.login <> b.login) "
    f"THEN b.update_ts - INTERVAL 1 MILLISECOND ELSE {OPEN} END AS active_to "
    "FROM users1 a LEFT JOIN users2 b ON a.bk = b.bk", "users1", "users2"))
def q_scd2_close(w: World) -> DataFrame:
    return scd2.scd2_close(users_sat_v1(w), users_batch_v2(w), "user_id_dwh", ["user_name", "user_login"])


@query("scd2_insert", sql(
    f"SELECT sha256(bk) AS user_id_dwh, name AS user_name, login AS user_login, update_ts AS active_from, "
    f"{OPEN} AS active_to FROM users1 UNION ALL "
    f"SELECT sha256(b.bk), b.name, b.login, b.update_ts, {OPEN} FROM users1 a JOIN users2 b ON a.bk = b.bk "
    f"WHERE a.name <> b.name OR a.login <> b.login", "users1", "users2"))
def q_scd2_insert(w: World) -> DataFrame:
    return scd2.scd2_insert(users_sat_v1(w), users_batch_v2(w), "user_id_dwh", ["user_name", "user_login"])


@query("sat_users", USERS_SAT)
def q_sat_users(w: World) -> DataFrame:
    return users_sat_v2(w)


@query("sat_restaurants", scd2_two_days("rest1", "rest2", "restaurant_id_dwh", [("name", "restaurant_name")]))
def q_sat_restaurants(w: World) -> DataFrame:
    key, attrs = "restaurant_id_dwh", ["restaurant_name"]
    sat = persisted(w, scd2.scd2_apply(w.empty("s_restaurants"), pipeline.restaurant_batch(
        w.stg_restaurants_v1, w.restaurant_hub, fx.FIRST_DAY), key, attrs), "s_restaurants")
    return scd2.scd2_apply(sat, pipeline.restaurant_batch(w.stg_restaurants_v2, w.restaurant_hub, fx.SECOND_DAY),
                           key, attrs)


PRODUCTS_SAT = scd2_two_days("prod1", "prod2", "product_id_dwh",
                             [("name", "product_name"), ("price", "product_price"), ("category", "product_category")])
PRODUCT_ATTRS = ["product_name", "product_price", "product_category"]


@query("sat_products", PRODUCTS_SAT)
def q_sat_products(w: World) -> DataFrame:
    sat = persisted(w, scd2.scd2_apply(w.empty("s_products"), pipeline.product_batch(
        w.stg_restaurants_v1, w.product_hub, fx.FIRST_DAY), "product_id_dwh", PRODUCT_ATTRS), "s_products")
    return scd2.scd2_apply(sat, pipeline.product_batch(w.stg_restaurants_v2, w.product_hub, fx.SECOND_DAY),
                           "product_id_dwh", PRODUCT_ATTRS)


@query("scd2_history", PRODUCTS_SAT)
def q_scd2_history(w: World) -> DataFrame:
    updates = pipeline.product_batch(w.stg_restaurants_v1.unionByName(w.stg_restaurants_v2), w.product_hub, None)
    return scd2.scd2_history(updates, "product_id_dwh", PRODUCT_ATTRS)


@query("sat_couriers",
       "SELECT sha256(CAST(n_nationkey AS VARCHAR)) AS courier_id_dwh, n_name AS courier_name, "
       "CAST(NULL AS TIMESTAMP) AS active_from, CAST(NULL AS TIMESTAMP) AS active_to FROM nation")
def q_sat_couriers(w: World) -> DataFrame:
    return vault.load_full_satellite(w.empty("s_couriers"), w.couriers, w.courier_hub)


def orders_sat(w: World) -> DataFrame:
    return vault.load_window_satellite(w.empty("s_orders"), w.stg_orders, w.order_hub(PREV, DAY), w.deliveries, DAY, 1)


@query("sat_orders", sql("SELECT * FROM sorders", "sorders"))
def q_sat_orders(w: World) -> DataFrame:
    return orders_sat(w)


# ======================================================================== metrics, quality (A4, Q1-Q8)

@query("load_metrics", sql(
    f"SELECT 'order_items' AS step, count(*) AS rows FROM items i JOIN ord o ON o.o_orderkey = i.l_orderkey "
    f"WHERE CAST(o.odate AS DATE) = {D} "
    f"UNION ALL SELECT 'order_bonuses', count(*) FROM bon b JOIN ord o ON o.o_orderkey = b.l_orderkey "
    f"WHERE CAST(o.odate AS DATE) = {D} "
    f"UNION ALL SELECT 'menu_products', count(*) FROM prod1 "
    f"UNION ALL SELECT 'l_orders', count(*) FROM link WHERE _day = {D} "
    f"UNION ALL SELECT 's_orders', count(*) FROM sorders", "ord", "items", "bon", "prod1", "link", "sorders"))
def q_load_metrics(w: World) -> DataFrame:
    return pipeline.load_metrics({
        "order_items": shred.shred_order_items(w.stg_orders, DAY),
        "order_bonuses": shred.shred_bonuses(w.outbox, DAY),
        "menu_products": shred.shred_menu(w.stg_restaurants_v1, fx.FIRST_DAY),
        "l_orders": q_link_orders_day(w),
        "s_orders": orders_sat(w),
    })


@query("dq_not_null", sql(
    "SELECT order_id_dwh, CASE WHEN order_rate IS NULL THEN 'not_null:order_rate' END AS rule FROM sorders",
    "sorders"))
def q_dq_not_null(w: World) -> DataFrame:
    rules = Q.not_null("order_id_dwh", "order_rate", "order_status", "order_create_ts")
    return Q.check(orders_sat(w), rules).select("order_id_dwh", "rule")


@query("dq_unique",
       "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id, "
       "CAST(l_quantity AS INTEGER) AS quantity, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_partkey) > 1 "
       "THEN 'unique:order_id,product_id' END AS rule FROM lineitem")
def q_dq_unique(w: World) -> DataFrame:
    raw = to_document(fx.orders_raw_source(w.t))
    items = shred.shred_order_items(raw, None)
    return Q.check(items, [Q.unique("order_id", "product_id")])


@query("dq_foreign_key", sql(
    f"SELECT order_id_dwh, CASE WHEN CAST(order_create_ts AS DATE) <> {D} THEN 'foreign_key:order_id_dwh' END AS rule "
    f"FROM sorders", "sorders"))
def q_dq_foreign_key(w: World) -> DataFrame:
    hub_d = w.order_hub(DAY, DAY)
    return Q.check(orders_sat(w), [Q.foreign_key("order_id_dwh", hub_d, "order_id_dwh")]).select("order_id_dwh", "rule")


@query("dq_lower_bound", sql(
    "SELECT order_id_dwh, product_id_dwh, CASE WHEN quantity <= 0 THEN 'lower_bound:quantity' "
    "WHEN bonus_payment < 0 THEN 'lower_bound:bonus_payment' WHEN bonus_grant < 0 THEN 'lower_bound:bonus_grant' "
    f"END AS rule FROM link WHERE _day = {D}", "link"))
def q_dq_lower_bound(w: World) -> DataFrame:
    rules = [Q.lower_bound("quantity", 0, inclusive=False), Q.lower_bound("bonus_payment", 0),
             Q.lower_bound("bonus_grant", 0)]
    return Q.check(q_link_orders_day(w), rules).select("order_id_dwh", "product_id_dwh", "rule")


@query("dq_range", sql(
    "SELECT order_id_dwh, order_rate, CASE WHEN order_rate NOT BETWEEN 1 AND 5 THEN 'range:order_rate' END AS rule "
    "FROM sorders", "sorders"))
def q_dq_range(w: World) -> DataFrame:
    return Q.check(orders_sat(w), [Q.in_range("order_rate", 1, 5)]).select("order_id_dwh", "order_rate", "rule")


@query("dq_length", sql(
    "SELECT order_id, address, CASE WHEN length(address) > 50 THEN 'max_length:address' "
    "WHEN length(order_id) > 24 THEN 'max_length:order_id' END AS rule FROM deliv", "deliv"))
def q_dq_length(w: World) -> DataFrame:
    rules = [Q.max_length("address", 50), Q.max_length("order_id", 24)]
    return Q.check(w.deliveries, rules).select("order_id", "address", "rule")


@query("dq_defaults", sql(
    "SELECT order_id_dwh, CAST(coalesce(order_tip_sum, 0) AS DECIMAL(8,2)) AS order_tip_sum, "
    "CAST(coalesce(order_rate, 5) AS SMALLINT) AS order_rate, order_status, order_address, order_create_ts, "
    "order_delivering_ts FROM sorders", "sorders"))
def q_dq_defaults(w: World) -> DataFrame:
    return Q.apply_defaults(orders_sat(w), "s_orders")


@query("dq_types", sql(
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, "
    "CAST(p_retailprice AS DECIMAL(8,2)) AS price, CAST(NULL AS VARCHAR) AS rule FROM part"))
def q_dq_types(w: World) -> DataFrame:
    raw = shred.json_explode(w.stg_restaurants_v1, "object_value", {"menu": [{"_id": None, "price": None}]},
                             "menu", [])
    rows = raw.select(F.col("_id").alias("product_id"), F.col("price").alias("price_text"))
    checked = Q.check(rows, [Q.conforms("price_text", "decimal(8,2)")])
    return checked.select("product_id", F.col("price_text").try_cast("decimal(8,2)").alias("price"), "rule")


@query("dq_ordered_versions", f"SELECT product_id_dwh, active_from, active_to, CASE WHEN active_to < active_from "
                              f"THEN 'ordered:active_from,active_to' END AS rule FROM ({PRODUCTS_SAT})")
def q_dq_ordered_versions(w: World) -> DataFrame:
    """Versions must not end before they start (an older update applied after a newer one)."""
    return Q.check(q_sat_products(w), [Q.ordered("active_from", "active_to")]).select(
        "product_id_dwh", "active_from", "active_to", "rule")


# Rows made from whole tables so that every declared rule meets rows that break it.

@query("dq_declared_order_rows", (
    "WITH r AS (SELECT o_orderkey AS order_key, CASE WHEN o_orderpriority = '1-URGENT' THEN 'c' || CAST(o_custkey AS VARCHAR) "
    "ELSE 'o' || CAST(o_orderkey AS VARCHAR) END AS k, CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 8 END AS rate, "
    "o_custkey % 11 - 1 AS tip, o_orderpriority AS status, repeat('Street ', CAST(o_custkey % 9 AS INTEGER)) AS address FROM orders) "
    "SELECT order_key, CASE WHEN rate IS NULL THEN 'not_null:order_rate' "
    "WHEN count(*) OVER (PARTITION BY k) > 1 THEN 'unique:order_id_dwh' WHEN tip < 0 THEN 'lower_bound:order_tip_sum' "
    "WHEN rate NOT BETWEEN 1 AND 5 THEN 'range:order_rate' WHEN length(status) > 9 THEN 'max_length:order_status' "
    "WHEN length(address) > 50 THEN 'max_length:order_address' END AS rule FROM r"))
def q_dq_declared_order_rows(w: World) -> DataFrame:
    """All orders as order-satellite rows against the rules that table declares."""
    rows = w.t("orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))).alias("order_id_dwh"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 8).cast("smallint").alias("order_rate"),
        (F.col("o_custkey") % 11 - 1).cast("decimal(8,2)").alias("order_tip_sum"),
        F.col("o_orderpriority").alias("order_status"), F.col("o_orderdate").alias("order_create_ts"),
        F.expr("repeat('Street ', cast(o_custkey % 9 AS int))").alias("order_address"))
    return Q.check(rows, Q.declared_rules("s_orders")).select("order_key", "rule")


@query("dq_declared_link_rows", (
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'not_null:restaurant_id_dwh' "
    "WHEN count(*) OVER (PARTITION BY l_orderkey, l_partkey) > 1 THEN 'unique:order_id_dwh,product_id_dwh' "
    "WHEN CAST(l_quantity AS INTEGER) <= 10 THEN 'lower_bound:quantity' WHEN l_linenumber < 2 THEN 'lower_bound:bonus_payment' "
    "WHEN l_linenumber < 3 THEN 'lower_bound:bonus_grant' WHEN p_partkey IS NULL THEN 'foreign_key:product_id_dwh' END AS rule "
    "FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size < 40) p ON p_partkey = l_partkey"))
def q_dq_declared_link_rows(w: World) -> DataFrame:
    """All order lines as link rows against the rules the link declares and a product reference with gaps."""
    text = lambda c: F.col(c).cast("string")
    rows = w.t("lineitem").select(
        "l_orderkey", "l_linenumber", text("l_orderkey").alias("order_id_dwh"), text("l_orderkey").alias("user_id_dwh"),
        F.when(F.col("l_returnflag") != "R", text("l_suppkey")).alias("restaurant_id_dwh"),
        text("l_partkey").alias("product_id_dwh"), (F.col("l_quantity").cast("int") - 10).alias("quantity"),
        (F.col("l_linenumber") - 2).cast("decimal(8,2)").alias("bonus_payment"),
        (F.col("l_linenumber") - 3).cast("decimal(8,2)").alias("bonus_grant"))
    known = w.t("part").where("p_size < 40").select(text("p_partkey").alias("product_id_dwh"))
    rules = Q.declared_rules("l_orders", {"product_id_dwh": (known, "product_id_dwh")})
    return Q.check(rows, rules).select("l_orderkey", "l_linenumber", "rule")


@query("dq_type_violations", (
    "SELECT p_partkey, CASE WHEN TRY_CAST(price AS DECIMAL(8,2)) IS NULL THEN 'type:price' END AS rule FROM (SELECT p_partkey, "
    "CASE p_size % 4 WHEN 0 THEN p_brand WHEN 1 THEN CAST(p_partkey + 1000000 AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END "
    "AS price FROM part)"))
def q_dq_type_violations(w: World) -> DataFrame:
    """Price texts of all parts: some are words, some too large for the declared type."""
    kind = F.col("p_size") % 4
    price = F.when(kind == 0, F.col("p_brand")).when(kind == 1, (F.col("p_partkey") + 1000000).cast("string"))
    rows = w.t("part").select("p_partkey", price.otherwise(F.col("p_partkey").cast("string")).alias("price"))
    return Q.check(rows, [Q.conforms("price", "decimal(8,2)")]).select("p_partkey", "rule")


@query("dq_reversed_versions", (
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_custkey % 3 = 0 THEN 'ordered:active_from,active_to' END AS rule FROM orders"))
def q_dq_reversed_versions(w: World) -> DataFrame:
    """Versions made from all orders: some end a day before they start, some have no end."""
    rows = w.t("orders").select("o_orderkey", F.col("o_orderdate").alias("active_from"), F.expr(
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + make_dt_interval(cast(o_custkey % 3 - 1 AS int)) END").alias("active_to"))
    return Q.check(rows, [Q.ordered("active_from", "active_to")]).select("o_orderkey", "rule")


# ======================================================================== streaming form of S1/S2/W1/W2

@query("stream_stage_documents", sql(
    "SELECT CAST(o_orderkey AS VARCHAR) AS object_id, odate AS update_ts, CAST(odate AS DATE) AS order_date FROM ord",
    "ord"))
def q_stream_stage_documents(w: World) -> DataFrame:
    """Orders arrive as files in three drops (business days 1-10, 11-20, 21-30); each drop is
    followed by one run of the staging stream.  Result: the stage after the last run."""
    from vaultspark.streaming import stage_documents_stream
    from vaultspark.streaming.documents import read_stage

    base = shared_dir(w.spark, "stream")
    landing, root, ckpt = f"{base}/landing", f"{base}/stage", f"{base}/checkpoint"
    src = w.orders_source
    day = F.dayofmonth("date")
    for i, (lo, hi) in enumerate(((1, 10), (11, 20), (21, 31))):
        ingest.land_json(src.where(day.between(lo, hi)), f"{landing}/drop={i}")
        stage_documents_stream(w.spark, f"{landing}/drop=*", src.schema, root, ckpt, "order_system_orders", to_order_document)
    return read_stage(w.spark, root, "order_system_orders").select("object_id", "update_ts", "order_date")


# ======================================================================== backfill of changing orders (B2)

# Versions of the orders, and for each order the version and day of the last run up to D that loaded it.
CHANGES = """ver AS (
  SELECT o.*, CAST(odate AS DATE) AS seen, CAST(odate AS DATE) AS business, o_custkey AS user_key, 0 AS more, o_orderstatus AS status FROM ord o
  UNION ALL SELECT o.*, CAST(odate AS DATE) + 1, CAST(odate AS DATE) + 1, 1 + o_custkey % (SELECT count(*) FROM customer), 1, o_orderstatus
    FROM ord o WHERE o_orderkey % 4 = 0
  UNION ALL SELECT o.*, CAST(odate AS DATE) + 2, CAST(odate AS DATE), 1 + o_custkey % (SELECT count(*) FROM customer), 2, o_orderstatus
    FROM ord o WHERE o_orderkey % 8 = 0
  UNION ALL SELECT o.*, CAST(odate AS DATE) + 1, CAST(odate AS DATE), o_custkey, 0, 'X' FROM ord o WHERE o_orderkey % 4 = 2),
runs AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-05', INTERVAL 1 DAY)) AS DATE) AS run),
seen_by AS (
  SELECT * FROM ver JOIN runs ON seen <= run QUALIFY row_number() OVER (PARTITION BY o_orderkey, run ORDER BY seen DESC) = 1)"""


def _last_load(days_back: int) -> str:
    return (f"last AS (SELECT * FROM seen_by WHERE business BETWEEN run - {days_back} AND run "
            "QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY run DESC) = 1)")


CHANGED_LINK = sql("", "items", "bon", "orest", "ord").rstrip() + f""",
{CHANGES}, {_last_load(0)},
dated AS (
  SELECT o_orderkey AS k, CAST(odate AS DATE) AS day FROM ord
  UNION ALL SELECT o_orderkey, CAST(odate AS DATE) + 1 FROM ord WHERE o_orderkey % 4 = 0)
SELECT sha256(CAST(o.o_orderkey AS VARCHAR)) AS order_id_dwh, sha256(CAST(r.rkey AS VARCHAR)) AS restaurant_id_dwh,
  sha256(CAST(o.user_key AS VARCHAR)) AS user_id_dwh,
  CASE WHEN o.o_orderstatus <> 'O' THEN sha256(CAST(o.o_orderkey % 25 AS VARCHAR)) END AS courier_id_dwh,
  sha256(CAST(i.l_partkey AS VARCHAR)) AS product_id_dwh, CAST(i.quantity + o.more AS INTEGER) AS quantity, b.bonus_payment, b.bonus_grant
FROM last o JOIN items i ON i.l_orderkey = o.o_orderkey
JOIN bon b ON b.l_orderkey = i.l_orderkey AND b.l_partkey = i.l_partkey
JOIN dated d ON d.k = o.o_orderkey AND d.day = o.run
JOIN orest r ON r.l_orderkey = o.o_orderkey
JOIN supplier s ON s.s_suppkey = r.rkey JOIN customer c ON c.c_custkey = o.user_key JOIN part p ON p.p_partkey = i.l_partkey"""

CHANGED_SATELLITE = sql("", "deliv").rstrip() + f""",
{CHANGES}, {_last_load(1)}
SELECT sha256(CAST(o.o_orderkey AS VARCHAR)) AS order_id_dwh, d.tip_sum AS order_tip_sum, d.rate AS order_rate, o.status AS order_status,
  d.address AS order_address, odate + to_days(CAST(business - CAST(odate AS DATE) AS INTEGER)) AS order_create_ts,
  d.delivery_ts AS order_delivering_ts
FROM last o LEFT JOIN deliv d ON d.order_id = CAST(o.o_orderkey AS VARCHAR)"""


@query("backfill_changed_orders", CHANGED_LINK)
def q_backfill_changed_orders(w: World) -> DataFrame:
    """The order link after the backfill of all days up to D, of orders that move, change owner and items."""
    return pipeline.backfill(w.spark, w.changing_sources(), fx.FIRST_DAY, DAY, save_root=shared_dir(w.spark, "backfill"))["l_orders"]


@query("backfill_changed_order_satellite", CHANGED_SATELLITE)
def q_backfill_changed_order_satellite(w: World) -> DataFrame:
    return pipeline.backfill(w.spark, w.changing_sources(), fx.FIRST_DAY, DAY, save_root=shared_dir(w.spark, "backfill"))["s_orders"]


# ======================================================================== whole pipeline (B1)

RUN_DAY_COUNTS = sql(
    "SELECT 'h_orders' AS table_name, count(*) AS rows FROM ord WHERE CAST(odate AS DATE) <= DATE '2024-01-05' "
    "UNION ALL SELECT 'h_restaurants', count(*) FROM supplier "
    "UNION ALL SELECT 'h_users', count(*) FROM customer "
    "UNION ALL SELECT 'h_products', count(*) FROM part "
    "UNION ALL SELECT 'h_couriers', count(*) FROM nation "
    "UNION ALL SELECT 'l_orders', count(*) FROM link WHERE _day <= DATE '2024-01-05' "
    "UNION ALL SELECT 's_orders', count(*) FROM ord WHERE CAST(odate AS DATE) <= DATE '2024-01-05' "
    f"UNION ALL SELECT 's_users', count(*) FROM ({USERS_SAT}) "
    f"UNION ALL SELECT 's_products', count(*) FROM ({PRODUCTS_SAT}) "
    f"UNION ALL SELECT 's_restaurants', count(*) FROM ({scd2_two_days('rest1', 'rest2', 'r', [('name', 'n')])}) "
    "UNION ALL SELECT 's_couriers', count(*) FROM nation "
    "UNION ALL SELECT 'order_system_orders', count(*) FROM ord WHERE CAST(odate AS DATE) <= DATE '2024-01-05' "
    "UNION ALL SELECT 'couriers_system_deliveries', count(*) FROM deliv "
    "WHERE CAST(order_ts AS DATE) <= DATE '2024-01-05'",
    "ord", "link", "deliv")

RUN_TABLES = ["h_orders", "h_restaurants", "h_users", "h_products", "h_couriers", "l_orders", "s_orders",
              "s_users", "s_products", "s_restaurants", "s_couriers", "order_system_orders",
              "couriers_system_deliveries"]


def after_run_day(w: World, written: dict[str, int], changes: dict | None = None) -> dict[str, DataFrame]:
    """State as of D-1 (bulk backfill from the first day; outbox and deliveries loaded into
    day-partitioned tables), then the persisted daily run of D, which replaces only the day
    partitions of those two."""
    sources = w.sources()
    root = shared_dir(w.spark, "warehouse")
    before = pipeline.backfill(w.spark, sources, fx.FIRST_DAY, PREV, save_root=f"{root}/bulk")
    before, day_tables = pipeline.register_day_tables(before, root, load=True, metrics=written)
    return pipeline.run_day(before, sources, DAY, root, metrics=written, day_tables=day_tables, changes=changes)


@query("run_day", RUN_DAY_COUNTS)
def q_run_day(w: World) -> DataFrame:
    """Row count of each table after the daily run."""
    written: dict[str, int] = {}
    after_run_day(w, written)
    return pipeline.metrics_frame(w.spark, written, DAY).where(F.col("table_name").isin(RUN_TABLES)).select(
        "table_name", "rows")


@query("run_day_balance", sql(
    "SELECT * FROM (SELECT 'l_orders' AS table_name, count(*) AS added, CAST(0 AS BIGINT) AS removed FROM link "
    f"WHERE _day = {D} "
    f"UNION ALL SELECT 's_orders', count(*), count(*) FILTER (CAST(odate AS DATE) = {D1}) FROM ord WHERE CAST(odate AS DATE) BETWEEN {D1} AND {D} "
    f"UNION ALL SELECT 'h_orders', count(*), 0 FROM ord WHERE CAST(odate AS DATE) = {D} "
    f"UNION ALL SELECT 'order_system_orders', count(*), 0 FROM ord WHERE CAST(odate AS DATE) = {D} "
    f"UNION ALL SELECT 'couriers_system_deliveries', count(*), count(*) FILTER (CAST(order_ts AS DATE) = {D1}) FROM deliv "
    f"WHERE CAST(order_ts AS DATE) BETWEEN {D1} AND {D} "
    f"UNION ALL SELECT 'bonus_system_outbox', count(*), 0 FROM outbox WHERE CAST(event_ts AS DATE) = {D} "
    "UNION ALL SELECT unnest(['h_restaurants', 'h_users', 'h_products', 'h_couriers', 's_restaurants', 's_users', 's_products']), 0, 0)",
    "link", "ord", "deliv", "outbox"))
def q_run_day_balance(w: World) -> DataFrame:
    """Rows that the daily run of D adds to and removes from its day and append tables, as the writes observe them."""
    changes: dict = {}
    after_run_day(w, {}, changes)
    return w.spark.createDataFrame([(t, c["added"], c["removed"]) for t, c in sorted(changes.items())],
                                   "table_name string, added bigint, removed bigint")


FLAWS = ("CASE WHEN CAST(order_id AS BIGINT) % 7 = 3 THEN 'l' WHEN CAST(order_id AS BIGINT) % 9 = 3 THEN 'r' ELSE '' END")


@query("run_day_rejects", sql(
    "SELECT 'couriers_system_deliveries' AS table_name, 'max_length:address' AS rule, count(*) AS rows FROM deliv "
    f"WHERE CAST(order_ts AS DATE) BETWEEN {D1} AND {D} AND {FLAWS} = 'l' "
    "UNION ALL SELECT 's_orders', 'not_null:order_rate', count(*) FROM ord LEFT JOIN deliv d ON d.order_id = CAST(o_orderkey AS VARCHAR) "
    f"WHERE CAST(odate AS DATE) BETWEEN {D1} AND {D} AND (d.order_id IS NULL OR {FLAWS} = 'l') "
    "UNION ALL SELECT 's_orders', 'range:order_rate', count(*) FROM ord JOIN deliv d ON d.order_id = CAST(o_orderkey AS VARCHAR) "
    f"WHERE CAST(odate AS DATE) BETWEEN {D1} AND {D} AND {FLAWS} = 'r'", "ord", "deliv"))
def q_run_day_rejects(w: World) -> DataFrame:
    """Rows that the daily run of D rejects, by table and declared rule, with deliveries that break some."""
    sources = w.sources() | {"deliveries": fx.flawed_deliveries(w.t)}
    rejected: dict[str, DataFrame] = {}
    root = shared_dir(w.spark, "warehouse")
    before = pipeline.backfill(w.spark, sources, fx.FIRST_DAY, PREV, save_root=root)
    pipeline.run_day(before, sources, DAY, root, on_violation="split", rejected=rejected)
    parts = [bad.select(F.lit(t).alias("table_name"), F.explode("rules").alias("rule")) for t, bad in sorted(rejected.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("table_name", "rule").agg(F.count(F.lit(1)).alias("rows"))


@query("run_day_contents", sql(
    "SELECT 'l_orders' AS table_name, order_id_dwh AS key, product_id_dwh AS product, bonus_payment AS amount, "
    "concat_ws('|', restaurant_id_dwh, user_id_dwh, courier_id_dwh, CAST(quantity AS VARCHAR)) AS attributes, "
    f"CAST(NULL AS TIMESTAMP) AS from_ts, CAST(NULL AS TIMESTAMP) AS to_ts FROM link WHERE _day <= {D} "
    "UNION ALL SELECT 's_products', product_id_dwh, NULL, product_price, concat_ws('|', product_name, product_category), "
    f"active_from, active_to FROM ({PRODUCTS_SAT}) "
    "UNION ALL SELECT 's_orders', sha256(CAST(o_orderkey AS VARCHAR)), NULL, d.tip_sum, "
    "concat_ws('|', o_orderstatus, CAST(d.rate AS VARCHAR), d.address), odate, d.delivery_ts "
    f"FROM ord LEFT JOIN deliv d ON d.order_id = CAST(o_orderkey AS VARCHAR) WHERE CAST(odate AS DATE) <= {D}",
    "link", "ord", "deliv"))
def q_run_day_contents(w: World) -> DataFrame:
    """Every row of the link, the product and the order satellite after the daily run."""
    s = after_run_day(w, {})
    none, never = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")

    def rows(table: str, key: str, product, amount: str, attributes: list[str], lo, hi) -> DataFrame:
        return s[table].select(
            F.lit(table).alias("table_name"), F.col(key).alias("key"), product.alias("product"), F.col(amount).alias("amount"),
            F.concat_ws("|", *[F.col(a).cast("string") for a in attributes]).alias("attributes"),
            lo.alias("from_ts"), hi.alias("to_ts"))

    return (rows("l_orders", "order_id_dwh", F.col("product_id_dwh"), "bonus_payment",
                 ["restaurant_id_dwh", "user_id_dwh", "courier_id_dwh", "quantity"], never, never)
            .union(rows("s_products", "product_id_dwh", none, "product_price", ["product_name", "product_category"],
                        F.col("active_from"), F.col("active_to")))
            .union(rows("s_orders", "order_id_dwh", none, "order_tip_sum", ["order_status", "order_rate", "order_address"],
                        F.col("order_create_ts"), F.col("order_delivering_ts"))))
