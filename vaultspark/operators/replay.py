"""Replay of many daily runs at once, for tables that are loaded by business day from documents that change.

A daily run of day ``d`` sees, of every document, the newest version staged by the end of ``d``, and loads those
whose business date lies in its window.  An order that changes after its day is loaded again only if a later run's
window holds the date that its then newest version carries; otherwise the rows of the earlier version stay.  So what a loop
of days leaves of an order is decided by one run, the last that loaded it.  ``last_loads`` finds that run and that version
for all orders by an as-of comparison of version intervals with business dates, and the loads below then join each order
with what had been staged by its own run: bonus lines, deliveries and hub keys carry the day on which they arrived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.functions.keys import unpacked_keys
from vaultspark.functions.time import DayLike, day_lit
from vaultspark.operators.shred import matched_lines, order_heads, parsed_orders, shred_dated_bonuses
from vaultspark.operators.vault import _hub_as, bk, dwh, packed_hub
from vaultspark.operators.writes import latest_per_key


def run_versions(documents: DataFrame, hi: DayLike, key: str = "object_id", ts: str = "update_ts") -> DataFrame:
    """One row per document and day on which it changed: its newest version of the day, with ``run_day`` (the run that
    staged it) and ``seen_until`` (the last run up to ``hi`` that saw it).

    Versions of a day are reduced before the shuffle, so the window below holds at most one row per document and day.
    """
    others = [c for c in documents.columns if c not in (key, ts)]
    newest = latest_per_key(documents.withColumn("run_day", F.to_date(ts)), [key, "run_day"],
                            [F.col(ts).desc()] + [F.col(c).desc() for c in others])
    following = F.lead("run_day").over(Window.partitionBy(key).orderBy("run_day"))
    return newest.withColumn("seen_until", F.coalesce(F.date_sub(following, 1), day_lit(hi)))


def last_loads(documents: DataFrame, lo: DayLike, hi: DayLike, days_back: int = 0) -> DataFrame:
    """The version with which each order was last loaded by the runs ``lo .. hi``, and ``load_day``, the day of that run.

    ``documents``: every version of the days ``lo .. hi`` with the typed ``order_date``.  A run of day ``d`` loads
    business days ``d - days_back .. d``.  Orders that no run loaded, and those without a business date, have no row.
    """
    return loads_of(run_versions(documents, hi), lo, hi, days_back)


def loads_of(versions: DataFrame, lo: DayLike, hi: DayLike, days_back: int = 0) -> DataFrame:
    """``last_loads`` from ``run_versions``, which loads with different windows share."""
    last = F.least(F.date_add("order_date", days_back), F.col("seen_until"), day_lit(hi))
    loads = versions.where(F.col("order_date").isNotNull()).withColumn("load_day", last)
    loads = loads.where((F.col("load_day") >= F.col("run_day")) & (F.col("load_day") >= F.col("order_date"))
                        & (F.col("load_day") >= day_lit(lo)))
    return latest_per_key(loads, ["object_id"], [F.col("load_day").desc()]).drop("run_day", "seen_until")


def first_days(keys: DataFrame, key: str, ts: str = "update_ts") -> DataFrame:
    """``(key, first_day)``: the run that brought a business key into its hub."""
    return keys.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("_bk")).agg(
        F.to_date(F.min(ts)).alias("first_day"))


def dated_hub(hub: DataFrame, entity: str, first: DataFrame) -> DataFrame:
    """The hub with the day on which each key arrived."""
    return hub.join(first, F.col(bk(entity)) == F.col("_bk")).drop("_bk")


def _known(hub: DataFrame, entity: str, name: str) -> DataFrame:
    """A dated hub under the names a load joins it by."""
    return hub.select(F.col(dwh(entity)), F.col(bk(entity)).alias(name), F.col("first_day").alias(f"_{entity}_day"))


def _arrived(col: str) -> Column:
    return F.col(col) <= F.col("load_day")


def replay_link(loads: DataFrame, outbox: DataFrame, deliveries: DataFrame, hubs: dict[str, DataFrame],
                days_back: int = 0) -> DataFrame:
    """Rows of the order link after the runs behind ``loads`` (``last_loads`` with the same ``days_back``).

    ``outbox`` and ``deliveries`` are the staged tables of those runs; the restaurant, user and product hubs are dated
    (``dated_hub``).  Keys and staged rows that arrived after an order's last load are not seen by it, as in the loop.
    Joined like ``vault.link_changes``; the load day is known once an order meets its bonus lines.
    """
    orders = parsed_orders(loads, ("load_day",))
    packed = {entity: packed_hub(hub, entity) for entity, hub in hubs.items()}
    bonuses = shred_dated_bonuses(outbox).select(
        F.col("order_id").alias("o_id"), F.col("product_id").alias("p_id"), "bonus_payment", "bonus_grant",
        F.col("event_day").alias("_event_day"), F.col("order_date").alias("_bonus_date"))
    couriers = deliveries.select(F.col("order_id").alias("o_id"), "courier_id", F.to_date("order_ts").alias("_delivery_day")).join(
        _hub_as(packed["courier"], "courier", "courier_id"), "courier_id", "left").drop("courier_id")
    window = F.col("_bonus_date").between(F.date_sub("load_day", days_back), F.col("load_day"))
    heads = order_heads(orders, ("load_day",))
    for entity, name in (("user", "user_id"), ("restaurant", "restaurant_id")):
        heads = heads.join(_known(packed[entity], entity, name).hint("merge"), name).where(_arrived(f"_{entity}_day")).drop(name, f"_{entity}_day")
    heads = _left_arrived(heads.join(_hub_as(packed["order"], "order", "o_id"), "o_id"), couriers)
    known = bonuses.join(_known(packed["product"], "product", "p_id").hint("merge"), "p_id")
    rows = heads.join(known.hint("merge"), "o_id").where(window & _arrived("_event_day") & _arrived("_product_day"))
    return unpacked_keys(matched_lines(rows, "p_id"), *map(dwh, hubs))


def _left_arrived(rows: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Left join on ``o_id`` with the deliveries staged by an order's last load."""
    d = deliveries.withColumnRenamed("o_id", "_d_id")
    return rows.join(d, (F.col("o_id") == F.col("_d_id")) & _arrived("_delivery_day"), "left").drop("_d_id", "_delivery_day")


def replay_order_satellite(loads: DataFrame, deliveries: DataFrame, order_hub: DataFrame) -> DataFrame:
    """Rows of the order satellite after the runs behind ``loads``."""
    orders = parsed_orders(loads, ("load_day",)).select(
        "load_day", F.col("object_id").alias("o_id"), "final_status", "order_ts").join(_hub_as(order_hub, "order", "o_id"), "o_id")
    dl = deliveries.select(F.col("order_id").alias("o_id"), "tip_sum", "rate", "address", "delivery_ts",
                           F.to_date("order_ts").alias("_delivery_day"))
    return _left_arrived(orders, dl).select(
        dwh("order"), F.col("tip_sum").alias("order_tip_sum"), F.col("rate").alias("order_rate"),
        F.col("final_status").alias("order_status"), F.col("address").alias("order_address"),
        F.col("order_ts").alias("order_create_ts"), F.col("delivery_ts").alias("order_delivering_ts"))
