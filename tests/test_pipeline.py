"""Daily runs: rerun safety and bulk backfill = loop of days (sf0.001)."""

import pytest

from tests.conftest import SF001, rows
from vaultspark.plans import pipeline
from vaultspark.plans.world import World
from vaultspark.session import shared_dir

CHECKED = ["h_orders", "h_products", "h_users", "l_orders", "s_products", "s_users", "s_restaurants", "s_orders",
           "order_system_orders", "couriers_system_deliveries", "bonus_system_outbox"]


@pytest.fixture(scope="module")
def world(spark):
    return World(spark, SF001)


def test_backfill_equals_day_loop(spark, world):
    src = world.sources()
    loop = pipeline.run_days(pipeline.empty_state(spark), src, "2024-01-01", "2024-01-02",
                             shared_dir(spark, "test-loop"))
    bulk = pipeline.backfill(spark, src, "2024-01-01", "2024-01-02")
    for t in CHECKED:
        assert rows(loop[t]) == rows(bulk[t]), t


def test_rerun_same_day_gives_same_tables(spark, world):
    src = world.sources()
    before = pipeline.backfill(spark, src, "2024-01-01", "2024-01-04")
    once = pipeline.run_day(before, src, "2024-01-05", shared_dir(spark, "test-once"))
    twice = pipeline.run_day(once, src, "2024-01-05", shared_dir(spark, "test-twice"))
    for t in CHECKED:
        assert rows(once[t]) == rows(twice[t]), t


def test_day_tables_give_the_same_run_and_rerun(spark, world):
    """Outbox and deliveries replaced one day partition at a time = replaced as whole new versions."""
    src = world.sources()
    before = pipeline.backfill(spark, src, "2024-01-01", "2024-01-04")
    plain = pipeline.run_day(before, src, "2024-01-05", shared_dir(spark, "test-plain"))
    expected = {t: rows(plain[t]) for t in CHECKED}
    root = shared_dir(spark, "test-day-tables")
    state, names = pipeline.register_day_tables(before, root, load=True)
    once = pipeline.run_day(state, src, "2024-01-05", root, day_tables=names)
    got = {t: rows(once[t]) for t in CHECKED}  # read now: the day tables change in place on the rerun
    assert got == expected
    again = pipeline.run_day(once, src, "2024-01-05", root, day_tables=names)
    assert {t: rows(again[t]) for t in CHECKED} == expected


def test_declared_rules_reject_rows_in_the_load(spark, world):
    """Orders without a rate or rated 9 are left out and reported; ``fail`` raises."""
    from pyspark.sql import functions as F

    from vaultspark.operators.quality import RuleViolation

    s = pipeline.empty_state(spark)
    s |= {pipeline.HUB_TABLES[e]: h for e, h in world.hubs_for_day("2024-01-04").items()}
    s |= {"bonus_system_outbox": world.outbox, "couriers_system_couriers": world.couriers}
    s["couriers_system_deliveries"] = world.deliveries.withColumn(
        "rate", F.when(F.col("courier_id") == "3", 9).otherwise(F.col("rate")).cast("smallint"))
    s["order_system_orders"] = world.stg_orders
    rejected = {}
    out = pipeline.run_dependents(s, "2024-01-04", on_violation="split", rejected=rejected)
    rules = {r[0] for r in rejected["s_orders"].select(F.explode("rules")).distinct().collect()}
    assert rules == {"not_null:order_rate", "range:order_rate"}
    assert out["s_orders"].where("order_rate = 9").isEmpty()
    assert {"l_orders", "s_products", "s_users", "s_restaurants", "s_couriers", "s_orders"} <= set(rejected)
    with pytest.raises(RuleViolation):
        pipeline.run_dependents(s, "2024-01-04", on_violation="fail")
