"""What must not grow faster than the input: rows shuffled with many keys, sources read again, loads of unpersisted plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, rows
from tests.test_replay import DAYS, LO, changing_sources
from vaultspark.operators import replay, vault
from vaultspark.plans import catalog, pipeline
from vaultspark.plans.world import World
from vaultspark.session import shared_dir

HI = LO + dt.timedelta(days=DAYS - 1)


def _exchanged(plan):
    """Columns of every shuffle in a physical plan."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _exchanged(plan.initialPlan())
    children = plan.children()
    own = [plan.output().mkString(",")] if plan.nodeName() == "Exchange" else []
    return own + [c for i in range(children.size()) for c in _exchanged(children.apply(i))]


def _hub(spark, entity, keys):
    return spark.createDataFrame([(f"{entity}-{k}", k) for k in keys], f"{entity}_id_dwh string, {entity}_id_bk string")


def _staged(spark):
    """Two versions of one order, a repeated item and bonus line, an order without delivery, one without a user."""
    docs = [("1", "a", "u1", '[{"id":"p","quantity":"1"},{"id":"p","quantity":"2"},{"id":"q","quantity":"3"}]'),
            ("1", "b", "u2", '[{"id":"q","quantity":"4"}]'), ("2", "a", "u1", '[{"id":"p","quantity":"5"},{"id":"x","quantity":"6"}]'),
            ("3", "a", None, '[{"id":"p","quantity":"7"}]')]
    staged = [(o, f'{{"date":"2024-01-05 10:00:00","restaurant":{{"id":"{r}"}},"user":{{"id":{f"{chr(34)}{u}{chr(34)}" if u else "null"}}},"final_status":"F","order_items":{i}}}',
               dt.datetime(2024, 1, 5, 10)) for o, r, u, i in docs]
    pay = lambda *ps: "[" + ",".join(f'{{"product_id":"{p}","bonus_payment":"{b}","bonus_grant":"1"}}' for p, b in ps) + "]"
    events = [("bonus_transaction", f'{{"order_id":"{o}","order_date":"2024-01-05 10:00:00","product_payments":{p}}}', dt.datetime(2024, 1, 5, 11))
              for o, p in (("1", pay(("p", 1), ("q", 2), ("q", 3))), ("2", pay(("p", 4), ("x", 5))), ("3", pay(("p", 6))))]
    hubs = {e: _hub(spark, e, k) for e, k in (("order", "123"), ("restaurant", "ab"), ("user", ["u1", "u2"]), ("product", "pq"), ("courier", "c"))}
    return (spark.createDataFrame(staged, "object_id string, object_value string, update_ts timestamp_ntz"),
            spark.createDataFrame(events, "event_type string, event_value string, event_ts timestamp_ntz"),
            spark.createDataFrame([("1", "c")], "order_id string, courier_id string"), hubs)


def test_link_rows_of_repeated_orders_items_and_bonus_lines(spark):
    _, out = vault.link_changes(*_staged(spark), "2024-01-05")
    got = rows(out.withColumn("bonus_payment", F.col("bonus_payment").cast("int")), "order_id_dwh", "restaurant_id_dwh", "user_id_dwh",
               "courier_id_dwh", "product_id_dwh", "quantity", "bonus_payment")
    one, two, three = ("order-1", "restaurant-a", "user-u1", "courier-c"), ("order-1", "restaurant-b", "user-u2", "courier-c"), ("order-2", "restaurant-a", "user-u1", None)
    assert got == sorted([(*one, "product-p", 1, 1), (*one, "product-p", 2, 1), (*one, "product-q", 3, 2), (*one, "product-q", 3, 3),
                          (*two, "product-q", 4, 2), (*two, "product-q", 4, 3), (*three, "product-p", 5, 4)], key=repr)


@pytest.fixture()
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_no_shuffle_of_the_link_carries_more_than_two_hub_keys(spark, no_broadcast):
    stage, outbox, deliveries, hubs = _staged(spark)
    _, link = vault.link_changes(stage, outbox, deliveries, hubs, None)
    dated = hubs | {e: h.withColumn("first_day", F.lit(dt.date(2024, 1, 1))) for e, h in hubs.items() if e in ("restaurant", "user", "product")}
    replayed = replay.replay_link(stage.withColumn("load_day", F.lit(dt.date(2024, 1, 5))), outbox,
                                  deliveries.withColumn("order_ts", F.lit(dt.datetime(2024, 1, 5))), dated)
    for plan in (link, replayed):
        shuffles = _exchanged(plan._jdf.queryExecution().executedPlan())
        assert len(shuffles) > 5 and max(s.count("_id_dwh") for s in shuffles) <= 2


def test_order_lines_are_shuffled_once_a_source(spark, no_broadcast):
    w = World(spark, SF001)
    for df in (w.orders_source, w.outbox):
        shuffles = _exchanged(df._jdf.queryExecution().executedPlan())
        assert sum("l_orderkey" in s for s in shuffles) == 1, shuffles


def test_backfill_reads_each_source_of_documents_once(spark):
    sources = changing_sources(spark, 5)
    seen = {c: spark.sparkContext.accumulator(0) for c in pipeline.DOCUMENT_COLLECTIONS}
    expected = {c: sources[c].count() for c in seen}

    def watched(c):
        def row(_):
            seen[c].add(1)
            return True

        return sources[c].where(F.udf(row, "boolean").asNondeterministic()("_id"))

    pipeline.backfill(spark, sources | {c: watched(c) for c in seen}, LO, HI, save_root=shared_dir(spark, "test-once"))
    assert {c: a.value for c, a in seen.items()} == expected


def test_daily_run_starts_from_saved_tables(spark, monkeypatch):
    """The bulk load behind ``run_day``, ``run_day_balance`` and ``run_day_contents`` reads files, not the plans from the sources."""
    loaded = {}

    def stop(state, *_, **__):
        loaded.update(state)
        raise InterruptedError

    monkeypatch.setattr(pipeline, "register_day_tables", stop)
    with pytest.raises(InterruptedError):
        catalog.after_run_day(World(spark, SF001), {})
    for t in ("l_orders", "s_orders", "h_orders", "order_system_orders", "bonus_system_outbox", "s_products"):
        plan = loaded[t]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan, t
