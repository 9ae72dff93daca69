from decimal import Decimal

from collections import Counter

import pytest

from vaultspark.operators import quality as Q


def test_declared_rules_reject_each_bad_row(spark):
    df = spark.createDataFrame([
        ("o1", Decimal("1.00"), 0, "ok", "addr"),        # rate 0
        ("o2", Decimal("1.00"), 6, "ok", "addr"),        # rate 6
        ("o3", Decimal("1.00"), None, "ok", "addr"),     # rate NULL
        ("o4", Decimal("-1.00"), 3, "ok", "addr"),       # negative tip
        ("o5", Decimal("1.00"), 3, "ok", "x" * 51),      # address too long
        ("o6", None, 3, "ok", None),                     # NULL tip / address pass
        ("o6", Decimal("1.00"), 3, "ok", "addr"),        # duplicate key
    ], "order_id_dwh string, order_tip_sum decimal(8,2), order_rate smallint, order_status string, "
       "order_address string")
    rules = Q.not_null("order_id_dwh", "order_rate") + [
        Q.unique("order_id_dwh"), Q.lower_bound("order_tip_sum", 0), Q.in_range("order_rate", 1, 5),
        Q.max_length("order_address", 50)]
    valid, rejected = Q.split_valid(df, rules)
    got = {r.order_id_dwh + ("#" if r.order_tip_sum is None else ""): r.rule for r in rejected.collect()}
    assert got == {"o1": "range:order_rate", "o2": "range:order_rate", "o3": "not_null:order_rate",
                   "o4": "lower_bound:order_tip_sum", "o5": "max_length:order_address",
                   "o6#": "unique:order_id_dwh", "o6": "unique:order_id_dwh"}
    assert valid.count() == 0


def test_link_rules_quantity_zero_negative_bonus_long_key(spark):
    df = spark.createDataFrame([("a", 0, Decimal("1")), ("b", 1, Decimal("-0.01")), ("c" * 25, 1, Decimal("0"))],
                               "k string, quantity int, bonus_payment decimal(8,2)")
    rules = [Q.lower_bound("quantity", 0, inclusive=False), Q.lower_bound("bonus_payment", 0),
             Q.max_length("k", 24)]
    got = {r.k: r.rule for r in Q.check(df, rules).collect()}
    assert got == {"a": "lower_bound:quantity", "b": "lower_bound:bonus_payment", "c" * 25: "max_length:k"}


def test_foreign_key_allows_null(spark):
    hub = spark.createDataFrame([("c1",)], "courier_id_dwh string")
    df = spark.createDataFrame([("c1",), ("c2",), (None,)], "courier_id_dwh string")
    got = sorted((r.courier_id_dwh or "", r.rule or "") for r in
                 Q.check(df, [Q.foreign_key("courier_id_dwh", hub, "courier_id_dwh")]).collect())
    assert got == [("", ""), ("c1", ""), ("c2", "foreign_key:courier_id_dwh")]


def test_fail_mode_raises(spark):
    df = spark.createDataFrame([(None,)], "a string")
    with pytest.raises(Q.RuleViolation):
        Q.split_valid(df, Q.not_null("a"), on_violation="fail")


def test_defaults_and_types(spark):
    df = spark.createDataFrame([(None, None), (Decimal("2.00"), 4)], "order_tip_sum decimal(8,2), order_rate smallint")
    out = sorted((r.order_tip_sum, r.order_rate) for r in Q.apply_defaults(df, "s_orders").collect())
    assert out == [(Decimal("0.00"), 5), (Decimal("2.00"), 4)]
    t = spark.createDataFrame([("12.5",), ("abc",), ("123456789.1",), (None,)], "price string")
    got = [r.rule for r in Q.check(t, [Q.conforms("price", "decimal(8,2)")]).collect()]
    assert sorted(got, key=str) == sorted([None, "type:price", "type:price", None], key=str)


def test_every_broken_rule_is_named_and_the_input_runs_once(spark):
    """Uniqueness, references and row rules together; hot duplicate keys and NULLs; the plan behind the rows runs once."""
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    ddl = "id int, ref string, n int"
    data = [(1, "a", 5), (1, "x", -1), (2, None, 0), (None, "a", 3), (None, "y", 3), (3, "a", None)] + [(9, "a", 1)] * 50
    df = spark.createDataFrame(data, ddl).mapInArrow(seen, ddl)
    hub = spark.createDataFrame([("a",), ("b",), ("a",)], "key string")
    rules = [*Q.not_null("id"), Q.unique("id"), Q.foreign_key("ref", hub, "key"), Q.lower_bound("n", 0), Q.max_length("ref", 0)]
    valid, rejected = Q.enforce(df, rules)
    got = Counter((r["id"], r["ref"], tuple(r["rules"])) for r in rejected.collect())
    assert got == {(1, "a", ("unique:id", "max_length:ref")): 1, (1, "x", ("unique:id", "foreign_key:ref", "lower_bound:n", "max_length:ref")): 1,
                   (None, "a", ("not_null:id", "max_length:ref")): 1, (None, "y", ("not_null:id", "foreign_key:ref", "max_length:ref")): 1,
                   (3, "a", ("max_length:ref",)): 1, (9, "a", ("unique:id", "max_length:ref")): 50}
    assert [tuple(r) for r in valid.collect()] == [(2, None, 0)]
    assert runs.value == len(data)
    with pytest.raises(Q.RuleViolation, match="unique:id"):
        Q.enforce(df, [Q.unique("id")], "fail")
    assert Q.validate(df.limit(0), rules).isEmpty()
