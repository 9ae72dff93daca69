"""Keys on their way through a shuffle."""

from pyspark.sql import functions as F

from vaultspark.functions.keys import hash_key, packed_keys, unpacked_keys
from vaultspark.operators import vault
from vaultspark.operators.shred import matched_lines, order_heads

from tests.test_growth import _exchanged, _staged, no_broadcast  # noqa: F401

KEYS = ["", "a", "ab", "abc", "AB", "order-1", "0g", "été", "\x01ab", None]


def test_packed_keys_are_the_same_again(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS)], "k string, n long")
    df = df.withColumn("h", hash_key("k"))
    packed = packed_keys(df, "k", "h", "n")
    assert dict(packed.dtypes) == {"k": "binary", "h": "binary", "n": "bigint"}
    assert {r["s"] for r in packed.select(F.length("h").alias("s")).collect()} == {33, None}
    back = unpacked_keys(packed, "k", "h", "n")
    assert back.dtypes == df.dtypes and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_the_link_shuffles_packed_keys(spark, no_broadcast):  # noqa: F811
    stage, outbox, deliveries, hubs = _staged(spark)
    hashed = {e: h.withColumn(f"{e}_id_dwh", hash_key(f"{e}_id_bk")) for e, h in hubs.items()}
    numbered = {e: h.withColumn(f"{e}_id_dwh", F.hash(f"{e}_id_bk").cast("long")) for e, h in hubs.items()}
    _, link = vault.link_changes(stage, outbox, deliveries, hashed, None)

    def kinds(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return kinds(plan.initialPlan())
        own = [f.dataType().typeName() for i in range(plan.output().size()) if (f := plan.output().apply(i)).name().endswith("_id_dwh")]
        children = plan.children()
        return own * (plan.nodeName() == "Exchange") + [k for i in range(children.size()) for k in kinds(children.apply(i))]

    assert len(found := kinds(link._jdf.queryExecution().executedPlan())) > 5 and set(found) == {"binary"}
    assert link.select("courier_id_dwh").dtypes == [("courier_id_dwh", "string")]
    _, other = vault.link_changes(stage, outbox, deliveries, numbered, None)
    names = {r["order_id_dwh"] for r in hashed["order"].collect()}
    assert {r["order_id_dwh"] for r in link.collect()} < names and link.count() == other.count() == 7
    assert {r["order_id_dwh"] for r in other.collect()} < {r["order_id_dwh"] for r in numbered["order"].collect()}


def test_items_of_an_order_meet_their_lines(spark):
    """Repeated items, items and lines without a product, orders with no items and with none known."""
    orders = spark.createDataFrame([("1", [("p", "1"), ("p", None), (None, "3")]), ("2", []), ("3", None)],
                                   "object_id string, order_items array<struct<id: string, quantity: string>>").selectExpr(
        "object_id", "date'2024-01-05' order_date", "'r' restaurant_id", "'u' user_id", "order_items")
    lines = spark.createDataFrame([("1", "p"), ("1", "q"), ("1", None), ("2", "p"), ("3", "p")], "o_id string, p_id string")
    got = matched_lines(order_heads(orders).join(lines, "o_id"), "p_id")
    assert sorted(map(repr, ((r["o_id"], r["p_id"], r["quantity"]) for r in got.collect()))) == ["('1', 'p', 1)", "('1', 'p', None)"]


def test_orders_and_bonus_lines_are_not_broadcast(spark):
    """Spark takes what comes out of documents for small."""
    stage, outbox, deliveries, hubs = _staged(spark)
    _, link = vault.link_changes(stage, outbox, deliveries, hubs, None)

    def built(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return built(plan.initialPlan())
        children = plan.children()
        own = [plan.output().mkString(",")] if plan.nodeName().startswith("BroadcastExchange") else []
        return own + [c for i in range(children.size()) for c in built(children.apply(i))]

    assert not [c for c in built(link._jdf.queryExecution().executedPlan()) if "items" in c or "bonus_payment" in c]
