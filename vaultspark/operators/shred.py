"""JSON shredding: staged documents -> rows of their nested arrays.

Each document is parsed once (``from_json`` with a minimal schema of string
leaves, FAILFAST) and its array exploded; the leaves are then cast with ANSI
casts.  A missing array yields no rows, an empty one yields none either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspark.functions.json import parse
from vaultspark.functions.time import DayLike, day_lit, in_days, previous_day

# Fields read from each document kind (everything else in the text is ignored).
ORDER_SPEC = {
    "date": None,
    "restaurant": {"id": None},
    "user": {"id": None},
    "final_status": None,
    "order_items": [{"id": None, "quantity": None}],
}
MENU_SPEC = {"name": None, "menu": [{"_id": None, "name": None, "price": None, "category": None}]}
BONUS_SPEC = {
    "order_id": None,
    "order_date": None,
    "product_payments": [{"product_id": None, "bonus_payment": None, "bonus_grant": None}],
}
USER_SPEC = {"name": None, "login": None}


def parsed_once(df: DataFrame, value: str, spec: dict, keep: list[str | Column], mode: str = "FAILFAST") -> DataFrame:
    """The ``keep`` columns and the document as ``_d``, parsed once a row.

    The document is the one element of an exploded array: a filter on its fields stays above the generator, while
    one above a plain projection is pushed below it together with a copy of the parse for every field.
    """
    kept = [F.col(k) if isinstance(k, str) else k for k in keep]
    return df.select(*kept, F.explode(F.array(parse(value, spec, mode))).alias("_d"))


def json_explode(df: DataFrame, value: str, spec: dict, array: str, keep: list[str | Column],
                 mode: str = "FAILFAST") -> DataFrame:
    """Generic shredder: parse ``value`` with ``spec`` and explode ``spec[array]``.

    Returns the ``keep`` columns plus the fields of each array element.
    """
    parsed = parsed_once(df, value, spec, keep, mode)
    names = [c for c in parsed.columns if c != "_d"]
    return parsed.select(*names, F.explode(F.col("_d")[array]).alias("_e")).select(*names, "_e.*")


def parsed_orders(stage: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Staged orders parsed once: ``object_id, update_ts, order_date, order_ts, restaurant_id,
    user_id, final_status, order_items``, after the ``keep`` columns of the stage."""
    p = parsed_once(stage, "object_value", ORDER_SPEC, [*keep, "object_id", "update_ts"])
    return p.select(
        *keep, "object_id", "update_ts",
        F.col("_d.date").cast("date").alias("order_date"),
        F.col("_d.date").cast("timestamp_ntz").alias("order_ts"),
        F.col("_d.restaurant.id").alias("restaurant_id"),
        F.col("_d.user.id").alias("user_id"),
        F.col("_d.final_status").alias("final_status"),
        F.col("_d.order_items").alias("order_items"),
    )


def orders_of_days(stage: DataFrame, day: DayLike | None, days_back: int = 0) -> DataFrame:
    """Parsed orders whose business date is ``day - days_back .. day`` (all when ``day`` is None).

    A stage with a typed ``order_date`` column is cut before any text is parsed.
    """
    if day is None:
        return parsed_orders(stage)
    window = (day_lit(previous_day(day, days_back)), day_lit(day))
    if "order_date" in stage.columns:
        stage = stage.where(F.col("order_date").between(*window))
    return parsed_orders(stage).where(F.col("order_date").between(*window))


def order_lines(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of parsed orders with their order's attributes, in one pass (no join back to the orders):
    ``o_id, order_date, restaurant_id, user_id, p_id, quantity``, after the ``keep`` columns of the orders."""
    e = orders.select(*keep, F.col("object_id").alias("o_id"), "order_date", "restaurant_id", "user_id",
                      F.explode("order_items").alias("_e"))
    return e.select(*keep, "o_id", "order_date", "restaurant_id", "user_id", F.col("_e.id").alias("p_id"),
                    F.col("_e.quantity").cast("int").alias("quantity"))


def order_heads(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed orders with their items still in one array: ``o_id, order_date, restaurant_id, user_id, items`` after the
    ``keep`` columns, for joins on what an order has once."""
    return orders.select(*keep, F.col("object_id").alias("o_id"), "order_date", "restaurant_id", "user_id",
                         F.transform("order_items", lambda i: F.struct(i["id"].alias("id"), i["quantity"].cast("int").alias("quantity"))).alias("items"))


def matched_lines(rows: DataFrame, product: str) -> DataFrame:
    """``rows`` once for each of their ``items`` of the product in ``product``, with its ``quantity`` instead of the items."""
    hits = F.filter("items", lambda i: i["id"] == F.col(product))
    others = [c for c in rows.columns if c != "items"]
    return rows.select(*others, F.explode(hits).alias("_e")).select(*others, F.col("_e.quantity").alias("quantity"))


def shred_order_items(stage: DataFrame, day: DayLike | None, days_back: int = 0) -> DataFrame:
    """``(order_id, product_id, quantity)`` of orders with business date in the window."""
    o = orders_of_days(stage, day, days_back)
    items = o.select(F.col("object_id").alias("order_id"), F.explode("order_items").alias("_e"))
    return items.select("order_id", F.col("_e.id").alias("product_id"),
                        F.col("_e.quantity").cast("int").alias("quantity"))


def shred_bonuses(outbox: DataFrame, day: DayLike | None, days_back: int = 0,
                  event_type: str = "bonus_transaction") -> DataFrame:
    """``(order_id, product_id, bonus_payment, bonus_grant)`` of bonus events of the window.

    An outbox with a typed ``order_date`` column (``to_outbox``) is cut before any text is parsed.
    """
    ev = outbox.where(F.col("event_type") == event_type)
    if day is not None and "order_date" in outbox.columns:
        ev = ev.where(F.col("order_date").between(day_lit(previous_day(day, days_back)), day_lit(day)))
    p = _bonuses(ev)
    if day is not None:
        p = p.where(F.col("order_date").between(day_lit(previous_day(day, days_back)), day_lit(day)))
    return _bonus_lines(p)


def shred_dated_bonuses(outbox: DataFrame, event_type: str = "bonus_transaction") -> DataFrame:
    """Bonus lines of all staged events with the day of the event and the business date of its order:
    ``event_day, order_date, order_id, product_id, bonus_payment, bonus_grant``."""
    ev = outbox.where(F.col("event_type") == event_type).withColumn("event_day", F.to_date("event_ts"))
    return _bonus_lines(_bonuses(ev, ["event_day"]), ["event_day", "order_date"])


def _bonuses(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    p = parsed_once(events, "event_value", BONUS_SPEC, keep or [])
    return p.select(*(keep or []), F.col("_d.order_id").alias("order_id"), F.col("_d.order_date").cast("date").alias("order_date"),
                    F.col("_d.product_payments").alias("_arr"))


def _bonus_lines(bonuses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    lines = bonuses.select(*(keep or []), "order_id", F.explode("_arr").alias("_e"))
    return lines.select(
        *(keep or []), "order_id",
        F.col("_e.product_id").alias("product_id"),
        F.col("_e.bonus_payment").cast("decimal(8,2)").alias("bonus_payment"),
        F.col("_e.bonus_grant").cast("decimal(8,2)").alias("bonus_grant"),
    )


def _updated(stage: DataFrame, day: DayLike | None) -> DataFrame:
    return stage if day is None else stage.where(in_days("update_ts", day))


def shred_menu(stage: DataFrame, day: DayLike | None) -> DataFrame:
    """Products of restaurants updated on ``day`` with the restaurant's ``update_ts``."""
    items = json_explode(_updated(stage, day), "object_value", MENU_SPEC, "menu", ["update_ts"])
    return items.select(
        F.col("_id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("price").cast("decimal(8,2)").alias("product_price"),
        F.col("category").alias("product_category"),
        "update_ts",
    )


def menu_product_keys(stage: DataFrame, day: DayLike | None) -> DataFrame:
    """Product business keys from the menus of restaurants updated on ``day``."""
    items = json_explode(_updated(stage, day), "object_value", {"menu": [{"_id": None}]}, "menu", [])
    return items.select(F.col("_id").alias("product_id"))


def shred_documents(stage: DataFrame, spec: dict, day: DayLike | None = None) -> DataFrame:
    """Top-level fields of staged documents updated on ``day``: ``object_id, update_ts, <fields>``."""
    p = _updated(stage, day).select("object_id", "update_ts", parse("object_value", spec).alias("_d"))
    return p.select("object_id", "update_ts", "_d.*")
