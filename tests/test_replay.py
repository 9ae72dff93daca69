"""Backfill in one plan = loop of daily runs, for orders that change after their day and keys that arrive late."""

import datetime as dt

import numpy as np
import pytest

from tests.conftest import rows
from vaultspark.plans import pipeline
from vaultspark.session import shared_dir

LO, DAYS = dt.date(2024, 3, 1), 3
TABLES = ["h_orders", "h_products", "h_users", "h_restaurants", "h_couriers", "l_orders", "s_orders", "s_products", "s_users",
          "s_restaurants", "order_system_orders", "couriers_system_deliveries", "bonus_system_outbox"]


def changing_sources(spark, seed):
    """Random versions of 14 orders (date, user, restaurant, items and status change), users and restaurants that are first
    seen on any day, menus that gain products, deliveries and bonus events that arrive on any day."""
    rng = np.random.default_rng(seed)

    def day(n=DAYS + 1):
        return LO + dt.timedelta(days=int(rng.integers(-1, n - 1)))

    def ts(d):
        return dt.datetime(d.year, d.month, d.day, int(rng.integers(0, 24)), int(rng.integers(0, 60)), int(rng.integers(0, 60)))

    pick = lambda n: str(int(rng.integers(0, n)))
    orders, outbox, deliveries, used = [], [], [], set()
    for k in range(14):
        first = day()
        for _ in range(int(rng.integers(1, 5))):
            seen = min(first + dt.timedelta(days=int(rng.integers(0, 3))), LO + dt.timedelta(days=DAYS))
            business = seen + dt.timedelta(days=int(rng.integers(-1, 2)))
            items = [(p, int(rng.integers(1, 9))) for p in sorted({pick(5) for _ in range(int(rng.integers(0, 4)))})]
            at = ts(seen)
            if (k, at) not in used:  # versions of one order at one time have no order
                used.add((k, at))
                orders.append((str(k), ts(business), (pick(3),), (pick(4),), pick(3), items, at))
            for d in {business, day()}:
                pays = ", ".join(f'{{"product_id": "{p}", "bonus_payment": {int(rng.integers(0, 9))}.5, "bonus_grant": 1.0}}' for p in range(5))
                outbox.append(("bonus_transaction", f'{{"order_id": "{k}", "order_date": "{business} 10:00:00", "product_payments": [{pays}]}}', ts(d)))
        if rng.random() < 0.7:
            deliveries.append((str(k), ts(day()), f"d{k}", pick(4), "street", ts(first), int(rng.integers(1, 6))))
    outbox.append(("other", "not json", ts(LO)))
    users = [(str(i), f"u{i}{v}", f"l{i}", ts(day())) for i in range(4) for v in range(2)]
    menus = [(str(i), f"r{i}{v}", [(str(p), f"p{p}", "1.50", "c") for p in range(i + v, 5)], ts(day())) for i in range(3) for v in range(2)]
    frame = spark.createDataFrame
    d = frame(deliveries, "order_id string, order_ts timestamp_ntz, delivery_id string, courier_id string, address string, delivery_ts timestamp_ntz, rate smallint")
    return {
        "orders": frame(orders, "_id string, date timestamp_ntz, restaurant struct<id:string>, user struct<id:string>, final_status string, "
                                "order_items array<struct<id:string,quantity:int>>, update_ts timestamp_ntz"),
        "restaurants": frame(menus, "_id string, name string, menu array<struct<_id:string,name:string,price:string,category:string>>, update_ts timestamp_ntz"),
        "users": frame(users, "_id string, name string, login string, update_ts timestamp_ntz"),
        "outbox": frame(outbox, "event_type string, event_value string, event_ts timestamp_ntz"),
        "bonus_users": frame([(1, "1")], "id int, order_user_id string"),
        "couriers": frame([(str(i), f"c{i}") for i in range(3)], "_id string, name string"),
        "deliveries": d.selectExpr("*", "cast(1 as decimal(14,2)) as sum", "cast(2 as decimal(8,2)) as tip_sum"),
    }


@pytest.mark.parametrize("seed,back", [(1, 0), (3, 1)])
def test_backfill_equals_the_loop_for_changing_orders(spark, seed, back):
    sources = changing_sources(spark, seed)
    hi = LO + dt.timedelta(days=DAYS - 1)
    state, day = pipeline.empty_state(spark), LO
    while day <= hi:
        state = pipeline.run_day(state, sources, day, shared_dir(spark, "test-replay"), link_days_back=back)
        day += dt.timedelta(days=1)
    bulk = pipeline.backfill(spark, sources, LO, hi, save_root=shared_dir(spark, "test-replay-bulk"), link_days_back=back)
    for t in TABLES:
        assert rows(bulk[t]) == rows(state[t]), t
    assert state["l_orders"].count() > 5 and state["s_orders"].count() > 5
