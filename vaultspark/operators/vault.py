"""Hub, link and non-versioned satellite loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.functions.keys import hash_key, packed_keys, unpacked_keys
from vaultspark.session import shared_dir
from vaultspark.functions.time import DayLike, day_lit, previous_day
from vaultspark.operators.shred import matched_lines, order_heads, orders_of_days, shred_bonuses
from vaultspark.operators.writes import _conform, delete_keys, replace_all

POSITION_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row position


def bk(entity: str) -> str:
    return f"{entity}_id_bk"


def dwh(entity: str) -> str:
    return f"{entity}_id_dwh"


def sequence_keys(new_keys: DataFrame, bk_col: str, dwh_col: str, start: Column) -> DataFrame:
    """Dense numbers ``start + 1, start + 2, ..`` for ``new_keys`` in business-key order.

    No single-partition window over the keys: they are range-sorted, numbered
    within each partition, and shifted by the row counts of the partitions before
    (a table with one row per partition, so its size is bounded and it may be
    broadcast).  The numbered keys are checkpointed first, so a recomputation
    cannot renumber them.
    """
    shared_dir(new_keys.sparkSession)  # reliable checkpoints go to the session's shared folder
    numbered = new_keys.select(bk_col).orderBy(bk_col).withColumn("_mid", F.monotonically_increasing_id())
    numbered = numbered.checkpoint(eager=True)
    part = F.shiftright("_mid", POSITION_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    counts = numbered.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0)).alias("_off"))
    j = numbered.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    return j.select((start + F.col("_off") + pos + 1).cast("long").alias(dwh_col), bk_col)


def new_keys(hub: DataFrame, batch: DataFrame, bk_col: str, entity: str) -> DataFrame:
    """Distinct non-NULL business keys of ``batch`` missing from the hub (``LEFT JOIN hub .. WHERE hub.bk IS NULL``).

    A hash join builds on its right side, and ``batch ANTI hub`` would put the
    (large, growing) hub there.  So the hub is first cut to the batch's keys
    (``hub SEMI batch keys``: the small side on the right, which AQE broadcasts
    when its runtime size allows), and the batch is anti-joined with that cut.
    """
    b = bk(entity)
    keys = batch.select(F.col(bk_col).cast("string").alias(b)).where(F.col(b).isNotNull()).dropDuplicates([b])
    known = hub.select(b).join(keys, b, "left_semi")
    return keys.join(known, b, "left_anti")


def hub_additions(hub: DataFrame, batch: DataFrame, bk_col: str, entity: str, key: str = "hash") -> DataFrame:
    """Only the rows ``load_hub`` adds: new business keys with their surrogate keys."""
    b, d = bk(entity), dwh(entity)
    fresh = new_keys(hub, batch, bk_col, entity)
    if key == "hash":
        return fresh.select(hash_key(b).alias(d), b)
    if key == "sequence":
        start = F.coalesce(hub.select(F.max(d)).scalar(), F.lit(0)).cast("long")
        return sequence_keys(fresh, b, d, start)
    raise ValueError(f"unknown key kind {key!r}")


def load_hub(hub: DataFrame, batch: DataFrame, bk_col: str, entity: str, key: str = "hash") -> DataFrame:
    """Insert business keys of ``batch`` that the hub lacks (``LEFT JOIN .. IS NULL``, ``ON CONFLICT DO NOTHING``).

    ``key="hash"``: surrogate = SHA-256 of the business key.  ``key="sequence"``:
    dense numbers after the hub's current maximum, in business-key order.
    """
    return hub.unionByName(_conform(hub_additions(hub, batch, bk_col, entity, key), hub))


def _hub_as(hub: DataFrame, entity: str, bk_name: str) -> DataFrame:
    return hub.select(F.col(dwh(entity)), F.col(bk(entity)).alias(bk_name))


def packed_hub(hub: DataFrame, entity: str) -> DataFrame:
    """A hub with its surrogate key packed, where it goes through further shuffles with the rows that are mapped."""
    return packed_keys(hub, dwh(entity))


def _deliveries_of(deliveries: DataFrame, stage_orders: DataFrame, orders: DataFrame, day: DayLike | None,
                   days_back: int) -> DataFrame:
    """Deliveries with their order's key as ``o_id``, cut to the window's orders (a semi join, so that a daily run
    never shuffles the history for its left join).  The keys come from the stage's typed business date, where it has one."""
    dl = deliveries.withColumnRenamed("order_id", "o_id")
    if day is None:
        return dl
    if "order_date" in stage_orders.columns:
        keys = stage_orders.where(F.col("order_date").between(day_lit(previous_day(day, days_back)), day_lit(day)))
    else:
        keys = orders
    return dl.join(keys.select(F.col("object_id").alias("o_id")), "o_id", "left_semi")


def link_changes(stage_orders: DataFrame, outbox: DataFrame, deliveries: DataFrame, hubs: dict[str, DataFrame],
                 day: DayLike | None, days_back: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(order keys whose link rows are deleted, new link rows with their order's business date)``.

    Each key is mapped where its rows are fewest and narrowest: restaurant and user on the orders, whose items stay in one
    array; the product on the bonus lines; the courier on the delivery, before the left join (lines without a delivery
    never meet on a NULL courier key).  All of these then meet on the order key, shuffled once each, and an order's items
    are matched with its bonus lines in place, so no row that carries several hub keys is shuffled a second time.  Keys are packed on
    the way.  Orders and bonus lines come out of documents, so Spark takes them for few; merge joins keep them from being broadcast.
    """
    orders = orders_of_days(stage_orders, day, days_back)
    packed = {entity: packed_hub(hub, entity) for entity, hub in hubs.items()}
    bn = shred_bonuses(outbox, day, days_back).select(
        F.col("order_id").alias("o_id"), F.col("product_id").alias("p_id"), "bonus_payment", "bonus_grant")
    dl = (_deliveries_of(deliveries, stage_orders, orders, day, days_back).select("o_id", "courier_id")
          .join(_hub_as(packed["courier"], "courier", "courier_id"), "courier_id", "left").select("o_id", dwh("courier")))
    heads = (order_heads(orders).join(_hub_as(packed["user"], "user", "user_id").hint("merge"), "user_id").drop("user_id")
             .join(_hub_as(packed["restaurant"], "restaurant", "restaurant_id"), "restaurant_id").drop("restaurant_id")
             .join(_hub_as(packed["order"], "order", "o_id"), "o_id").join(dl, "o_id", "left"))
    lines = bn.join(_hub_as(packed["product"], "product", "p_id").hint("merge"), "p_id")
    rows = unpacked_keys(matched_lines(heads.join(lines.hint("merge"), "o_id"), "p_id"), *map(dwh, hubs))
    keys = orders.select(F.col("object_id").alias("o_id"))
    dropped = keys.join(_hub_as(packed["order"], "order", "o_id"), "o_id").select(dwh("order"))  # the hub is shuffled once for both
    return unpacked_keys(dropped, dwh("order")), rows


def apply_changes(target: DataFrame, dropped: DataFrame, rows: DataFrame) -> DataFrame:
    """``target`` without the orders in ``dropped``, and with ``rows``."""
    return delete_keys(target, dropped, [dwh("order")]).unionByName(_conform(rows, target))


def load_link(link: DataFrame, stage_orders: DataFrame, outbox: DataFrame, deliveries: DataFrame,
              hubs: dict[str, DataFrame], day: DayLike | None, days_back: int = 0) -> DataFrame:
    """Order link for business day(s): delete the link rows of those orders, insert the star join.

    Inner joins: order items x bonus lines (an item without bonus line is
    dropped), the order and its restaurant / user / product hubs (keys missing
    from a hub drop the row).  Left joins: deliveries and the courier hub (no
    delivery -> NULL courier).  ``day=None`` loads all days at once (bulk).
    """
    return apply_changes(link, *link_changes(stage_orders, outbox, deliveries, hubs, day, days_back))


def order_satellite_changes(stage_orders: DataFrame, order_hub: DataFrame, deliveries: DataFrame, day: DayLike,
                            days_back: int = 1) -> tuple[DataFrame, DataFrame]:
    """``(order keys whose satellite rows are deleted, their new rows)``."""
    orders = orders_of_days(stage_orders, day, days_back)
    hit = orders.select(F.col("object_id").alias("o_id"), "final_status", "order_ts").join(
        _hub_as(order_hub, "order", "o_id"), "o_id")
    dl = _deliveries_of(deliveries, stage_orders, orders, day, days_back).select(
        "o_id", "tip_sum", "rate", "address", "delivery_ts")
    return hit.select(dwh("order")), hit.join(dl, "o_id", "left").select(
        dwh("order"),
        F.col("tip_sum").alias("order_tip_sum"),
        F.col("rate").alias("order_rate"),
        F.col("final_status").alias("order_status"),
        F.col("address").alias("order_address"),
        F.col("order_ts").alias("order_create_ts"),
        F.col("delivery_ts").alias("order_delivering_ts"),
    )


def load_window_satellite(sat: DataFrame, stage_orders: DataFrame, order_hub: DataFrame, deliveries: DataFrame,
                          day: DayLike, days_back: int = 1) -> DataFrame:
    """Order satellite: replace the orders of business days ``day - days_back .. day``.

    Delivery attributes come through a left join, so an order without delivery
    keeps NULL tip / rate / address / delivery time.
    """
    return apply_changes(sat, *order_satellite_changes(stage_orders, order_hub, deliveries, day, days_back))


def load_full_satellite(sat: DataFrame, couriers: DataFrame, courier_hub: DataFrame) -> DataFrame:
    """Courier satellite: rebuilt from the full courier list each run; validity columns NULL."""
    rows = couriers.join(_hub_as(courier_hub, "courier", "_id"), "_id").select(
        dwh("courier"),
        F.col("name").alias("courier_name"),
        F.lit(None).cast("timestamp_ntz").alias("active_from"),
        F.lit(None).cast("timestamp_ntz").alias("active_to"),
    )
    return replace_all(sat, rows)
