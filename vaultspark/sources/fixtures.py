"""Source-shaped frames derived from the driver's TPC-H-like tables.

The reference's sources (a document store, a relational bonus system and an
HTTP courier service) are not available, so their objects are derived from the
given tables by fixed recipes (see FIXTURES.md).  Everything stays a lazy
DataFrame over the parquet files, so the work of every load grows with the
tables.

Documents (restaurants with their menu, orders with their items, bonus events
with their payments) hold an array per object.  Their size is the size of one
source document (a menu, the lines of one order), never a whole table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.functions.time import ts_lit

# Fixed values of the recipes.
T0 = "2024-01-01 00:00:00"   # first business day of the fixture
BUSINESS_DAYS = 30            # business dates fold onto 2024-01-01 .. 2024-01-30
COURIERS = 25                 # deliveries are spread over this many couriers
TEST_DAY = "2024-01-05"       # day D of the registered queries
FIRST_DAY = "2024-01-01"      # v1 of restaurants / users is updated on this day
SECOND_DAY = "2024-01-02"     # v2 of restaurants / users is updated on this day

DEC8 = T.DecimalType(8, 2)
DEC14 = T.DecimalType(14, 2)

MENU_ITEM = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("price", DEC8), T.StructField("category", T.StringType()),
])
ORDER_ITEM = T.StructType([T.StructField("id", T.StringType()), T.StructField("quantity", T.IntegerType())])


class Tables:
    """Lazy access to the driver tables ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def at(days: Column, hours: Column | None = None, minutes: Column | None = None) -> Column:
    """``T0 + days + hours + minutes`` as ``timestamp_ntz``."""
    zero = F.lit(0)
    return ts_lit(T0) + F.make_dt_interval(
        days.cast("int"),
        (hours if hours is not None else zero).cast("int"),
        (minutes if minutes is not None else zero).cast("int"),
    )


def order_date(orderkey: Column) -> Column:
    """Business date (= update time) of an order."""
    return at(orderkey % BUSINESS_DAYS, orderkey % 24)


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# ---------------------------------------------------------------- users

def users_v1(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select(
        _s("c_custkey").alias("_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_mktsegment"), _s("c_custkey")).alias("login"),
        at(F.lit(0), F.col("c_custkey") % 24).alias("update_ts"),
    )


def users_v2(t: Tables) -> DataFrame:
    """Next-day update of every third user: a quarter of them change login or name."""
    c = t("customer").where(F.col("c_custkey") % 3 == 0)
    k = F.col("c_custkey")
    return c.select(
        _s("c_custkey").alias("_id"),
        F.when(k % 12 == 6, F.concat("c_name", F.lit(" v2"))).otherwise(F.col("c_name")).alias("name"),
        F.concat(F.lower("c_mktsegment"), _s("c_custkey"),
                 F.when(k % 12 == 0, F.lit("_2")).otherwise(F.lit(""))).alias("login"),
        at(F.lit(1), k % 24).alias("update_ts"),
    )


# ---------------------------------------------------------------- restaurants

def _menu_items(t: Tables, price_bump: bool) -> DataFrame:
    n_suppliers = t("supplier").select(F.count("*")).scalar()
    p = t("part")
    price = F.col("p_retailprice").cast(DEC8)
    if price_bump:
        price = F.when(F.col("p_partkey") % 2 == 0, (price + F.lit(Decimal("1.00"))).cast(DEC8)).otherwise(price)
    return p.select(
        (F.col("p_partkey") % n_suppliers).alias("s_suppkey"),
        F.struct(_s("p_partkey").alias("_id"), F.col("p_name").alias("name"),
                 price.alias("price"), F.col("p_type").alias("category")).alias("item"),
    )


def _restaurants(t: Tables, v2: bool) -> DataFrame:
    s = t("supplier")
    if v2:
        s = s.where(F.col("s_suppkey") % 3 == 0)
    menus = _menu_items(t, price_bump=v2).groupBy("s_suppkey").agg(
        F.array_sort(F.collect_list("item")).alias("menu"))
    k = F.col("s_suppkey")
    name = F.col("s_name")
    if v2:
        name = F.when(k % 6 == 0, F.concat(name, F.lit(" v2"))).otherwise(name)
    return s.join(menus, "s_suppkey", "left").select(
        _s("s_suppkey").alias("_id"),
        name.alias("name"),
        F.coalesce(F.col("menu"), F.array().cast(T.ArrayType(MENU_ITEM))).alias("menu"),
        at(F.lit(1 if v2 else 0), k % 24).alias("update_ts"),
    )


def restaurants_v1(t: Tables) -> DataFrame:
    return _restaurants(t, v2=False)


def restaurants_v2(t: Tables) -> DataFrame:
    """Next-day update of every third restaurant: half rename, even parts get +1.00."""
    return _restaurants(t, v2=True)


# ---------------------------------------------------------------- orders

def _lines(t: Tables, *columns: str) -> DataFrame:
    """Order lines dealt by order: they are shuffled once for the sums per part, the array per order and the join with the orders."""
    return t("lineitem").select("l_orderkey", *columns).repartition("l_orderkey")


def _orders(t: Tables, items: DataFrame) -> DataFrame:
    o = t("orders")
    k = F.col("o_orderkey")
    return o.join(items, o.o_orderkey == items.l_orderkey, "left").select(
        _s("o_orderkey").alias("_id"),
        order_date(k).alias("date"),
        F.struct(_s("restaurant_key").alias("id")).alias("restaurant"),
        F.struct(_s("o_custkey").alias("id")).alias("user"),
        F.col("o_orderstatus").alias("final_status"),
        F.coalesce(F.col("order_items"), F.array().cast(T.ArrayType(ORDER_ITEM))).alias("order_items"),
        order_date(k).alias("update_ts"),
    )


def orders_source(t: Tables) -> DataFrame:
    """Order documents: one item per (order, part) with summed quantity."""
    per_part = _lines(t, "l_partkey", "l_quantity", "l_suppkey").groupBy("l_orderkey", "l_partkey").agg(
        F.sum(F.col("l_quantity").cast("int")).cast("int").alias("quantity"),
        F.min("l_suppkey").alias("supp"),
    )
    items = per_part.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(_s("l_partkey").alias("id"), F.col("quantity")))).alias("order_items"),
        F.min("supp").alias("restaurant_key"),
    )
    return _orders(t, items)


def orders_raw_source(t: Tables) -> DataFrame:
    """Order documents with one item per line, so an (order, product) pair may repeat."""
    items = t("lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("l_linenumber").alias("n"), _s("l_partkey").alias("id"),
            F.col("l_quantity").cast("int").alias("quantity")))).alias("lines"),
        F.min("l_suppkey").alias("restaurant_key"),
    ).select("l_orderkey", "restaurant_key",
             F.transform("lines", lambda x: F.struct(x["id"].alias("id"), x["quantity"].alias("quantity")))
             .alias("order_items"))
    return _orders(t, items)


def changed_orders_source(t: Tables) -> DataFrame:
    """Order documents that change after their day.

    Every fourth order is updated a day later: it moves to that day, belongs to the next customer and takes one more of
    each item.  Of these every second one moves back another day later, with one more of each item.  Every
    fourth order counted from the second is updated a day later with another status alone.
    """
    k, o = F.col("_id").cast("long"), orders_source(t)
    n_users = t("customer").select(F.count("*")).scalar()

    def version(chosen: Column, days: int, moved: int, more: int, next_user: bool, status: str | None) -> DataFrame:
        user = (1 + F.col("user.id").cast("long") % n_users).cast("string") if next_user else F.col("user.id")
        items = F.transform("order_items", lambda i: F.struct(i["id"].alias("id"), (i["quantity"] + more).alias("quantity")))
        return o.where(chosen).select(
            "_id", (F.col("date") + F.make_dt_interval(F.lit(moved))).alias("date"), "restaurant", F.struct(user.alias("id")).alias("user"),
            (F.lit(status) if status else F.col("final_status")).alias("final_status"), items.alias("order_items"),
            (F.col("update_ts") + F.make_dt_interval(F.lit(days))).alias("update_ts"))

    return (o.unionByName(version(k % 4 == 0, 1, 1, 1, True, None)).unionByName(version(k % 8 == 0, 2, 0, 2, True, None))
            .unionByName(version(k % 4 == 2, 1, 0, 0, False, "X")))


# ---------------------------------------------------------------- bonus system

def bonus_events(t: Tables) -> DataFrame:
    """Outbox rows of type ``bonus_transaction`` (one per order with bonus lines)."""
    per_part = _lines(t, "l_partkey", "l_extendedprice", "l_returnflag").where(F.col("l_returnflag") != "R").groupBy("l_orderkey", "l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast(DEC14)).alias("s"))
    pay = F.struct(
        _s("l_partkey").alias("product_id"),
        (F.col("s") * F.lit(Decimal("0.05"))).cast(DEC8).alias("bonus_payment"),
        (F.col("s") * F.lit(Decimal("0.01"))).cast(DEC8).alias("bonus_grant"),
    )
    ev = per_part.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(pay)).alias("product_payments"))
    d = order_date(F.col("l_orderkey"))
    value = F.to_json(
        F.struct(_s("l_orderkey").alias("order_id"), d.alias("order_date"), F.col("product_payments")),
        {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"},
    )
    return ev.select(F.lit("bonus_transaction").alias("event_type"), value.alias("event_value"), d.alias("event_ts"))


def moved_bonus_events(t: Tables) -> DataFrame:
    """Bonus transactions of the orders that ``changed_orders_source`` moves to the next day, dated that day."""
    spec = "order_id string, order_date string, product_payments array<struct<product_id:string,bonus_payment:string,bonus_grant:string>>"
    e = bonus_events(t).withColumn("_d", F.from_json("event_value", spec)).where(F.col("_d.order_id").cast("long") % 4 == 0)
    ts = F.col("event_ts") + F.make_dt_interval(F.lit(1))
    value = F.to_json(F.struct(F.col("_d.order_id").alias("order_id"), ts.alias("order_date"),
                               F.col("_d.product_payments").alias("product_payments")),
                      {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    return e.select("event_type", value.alias("event_value"), ts.alias("event_ts"))


def other_events(t: Tables) -> DataFrame:
    """The ``events`` table as outbox rows."""
    return t("events").select("event_type", F.col("props").alias("event_value"), F.col("ts").alias("event_ts"))


def outbox(t: Tables) -> DataFrame:
    return other_events(t).unionByName(bonus_events(t))


def bonus_users(t: Tables) -> DataFrame:
    return t("customer").select(F.col("c_custkey").cast("int").alias("id"), _s("c_custkey").alias("order_user_id"))


# ---------------------------------------------------------------- courier service

def couriers(t: Tables) -> DataFrame:
    return t("nation").select(_s("n_nationkey").alias("_id"), F.col("n_name").alias("name"))


def deliveries(t: Tables) -> DataFrame:
    o = t("orders").where(F.col("o_orderstatus") != "O")
    k = F.col("o_orderkey")
    total = F.col("o_totalprice").cast(DEC14)
    return o.select(
        _s("o_orderkey").alias("order_id"),
        order_date(k).alias("order_ts"),
        F.concat(F.lit("d"), _s("o_orderkey")).alias("delivery_id"),
        (k % COURIERS).cast("string").alias("courier_id"),
        F.concat(F.lit("Street "), _s("o_custkey")).alias("address"),
        at(k % BUSINESS_DAYS, k % 24, 20 + k % 60).alias("delivery_ts"),
        (1 + k % 5).cast("smallint").alias("rate"),
        total.alias("sum"),
        (total * F.lit(Decimal("0.01"))).cast(DEC8).alias("tip_sum"),
    )


def flawed_deliveries(t: Tables) -> DataFrame:
    """Deliveries of which some break a declared rule: an address that is too long, or a rate of 9."""
    k = F.col("order_id").cast("long")
    return deliveries(t).withColumns({
        "address": F.when(k % 7 == 3, F.repeat(F.lit("long "), 20)).otherwise(F.col("address")),
        "rate": F.when(k % 9 == 3, 9).otherwise(F.col("rate")).cast("smallint")})
