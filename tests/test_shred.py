import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import rows
from vaultspark.operators import shred

DOC = "object_id string, object_value string, update_ts timestamp_ntz"
T = dt.datetime(2024, 1, 1, 10)


def stage(spark, *values):
    return spark.createDataFrame([(str(i), v, T) for i, v in enumerate(values)], DOC)


def test_missing_and_empty_menu_give_no_rows(spark):
    st = stage(spark, '{"name": "a"}', '{"name": "b", "menu": []}', '{"name": "c", "menu": null}')
    assert shred.shred_menu(st, "2024-01-01").count() == 0


def test_menu_fields_bound_by_name_and_price_rounds_half_up(spark):
    st = stage(spark, '{"menu": [{"price": "10.005", "category": "X", "name": "soup", "_id": "p1"}]}')
    got = shred.shred_menu(st, "2024-01-01").first()
    assert (got.product_id, got.product_name, got.product_price, got.product_category) == \
        ("p1", "soup", Decimal("10.01"), "X")


def test_price_over_decimal_8_2_fails(spark):
    st = stage(spark, '{"menu": [{"_id": "p1", "name": "n", "price": 12345678.5, "category": "c"}]}')
    with pytest.raises(Exception):
        shred.shred_menu(st, "2024-01-01").collect()


def test_quantity_text_2_0_fails(spark):
    st = spark.createDataFrame([("o1", '{"date": "2024-01-05 10:00:00", "order_items": [{"id": "p", "quantity": "2.0"}]}',
                                 T)], DOC)
    with pytest.raises(Exception):
        shred.shred_order_items(st, "2024-01-05").collect()


def test_order_items_of_business_day(spark):
    st = spark.createDataFrame([
        ("o1", '{"date": "2024-01-05 10:00:00", "order_items": [{"id": "p", "quantity": 2}, {"id": "q", "quantity": 1}]}', T),
        ("o2", '{"date": "2024-01-04 10:00:00", "order_items": [{"id": "p", "quantity": 5}]}', T),
        ("o3", '{"date": "2024-01-05 11:00:00", "order_items": []}', T),
    ], DOC)
    assert rows(shred.shred_order_items(st, "2024-01-05")) == [("o1", "p", 2), ("o1", "q", 1)]


def test_bonuses_only_bonus_events_of_the_day(spark):
    ob = spark.createDataFrame([
        ("bonus_transaction", '{"order_id": "o1", "order_date": "2024-01-05 09:00:00", '
                              '"product_payments": [{"product_id": "p", "bonus_payment": 1.5, "bonus_grant": 0.25}]}', T),
        ("bonus_transaction", '{"order_id": "o2", "order_date": "2024-01-06 09:00:00", '
                              '"product_payments": [{"product_id": "p", "bonus_payment": 1, "bonus_grant": 0}]}', T),
        ("click", '{"k": 1}', T),
    ], "event_type string, event_value string, event_ts timestamp_ntz")
    assert rows(shred.shred_bonuses(ob, "2024-01-05")) == [("o1", "p", Decimal("1.50"), Decimal("0.25"))]
