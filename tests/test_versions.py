"""Versioned satellites kept by the day on which a version ends."""

import os

from pyspark.sql import functions as F

from tests.conftest import rows
from vaultspark.functions.json import to_outbox
from vaultspark.functions.time import OPEN_TO, ts_lit
from vaultspark.operators import scd2, shred
from vaultspark.plans import pipeline
from vaultspark.session import shared_dir
from vaultspark.sources.store import save_table

ATTRS = ["user_name", "user_login"]
BATCHES = [
    ("2024-01-01", [("u1", "a", "x"), ("u2", "b", "y"), ("u3", None, "z")]),
    ("2024-01-02", [("u1", "a2", "x"), ("u2", "b", "y"), ("u3", "c", "z"), ("u1", "a1", "x")]),
    ("2024-01-03", [("u1", "a", "x"), ("u4", "d", "w"), ("u2", "b", "y2")]),
    ("2024-01-04", []),
]


def _batch(spark, day, data):
    df = spark.createDataFrame(data, "user_id_dwh string, user_name string, user_login string")
    return df.withColumn("update_ts", ts_lit(f"{day} 10:00:00"))


def test_changes_of_the_open_versions_equal_the_whole_satellite(spark):
    sat = pipeline.empty_state(spark)["s_users"]
    for day, data in BATCHES:
        batch = _batch(spark, day, data)
        whole = scd2.scd2_apply(sat, batch, "user_id_dwh", ATTRS)
        changes = scd2.scd2_changes(sat, batch, "user_id_dwh", ATTRS)
        ended = changes.where(F.col("active_to") != ts_lit(OPEN_TO)).select("user_id_dwh", ts_lit(OPEN_TO).alias("active_to"))
        kept = sat.join(ended, ["user_id_dwh", "active_to"], "left_anti")
        assert rows(kept.select(sat.columns).unionByName(changes)) == rows(whole)
        assert scd2.scd2_changes(whole, batch, "user_id_dwh", ATTRS).isEmpty()  # a rerun changes nothing
        sat = spark.createDataFrame(whole.collect(), sat.schema)


def _files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_a_run_leaves_the_partitions_of_older_days_alone(spark, monkeypatch):
    state, names = pipeline.register_day_tables(pipeline.empty_state(spark), root := shared_dir(spark, "test-versions"), load=True)
    batches = iter([_batch(spark, *b) for b in BATCHES])
    monkeypatch.setattr(pipeline, "user_batch", lambda *_: next(batches))
    seen = []
    for day, _ in BATCHES[:3]:
        state = pipeline.run_dependents(state, day, day_tables=names)
        seen.append(_files(f"{root}/s_users"))
    assert {f.split("part_day=")[1].split("/")[0] for f in seen[2]} == {"2024-01-02", "2024-01-03", "2099-12-01"}
    closed = {f for f in seen[1] if "part_day=2024-01-02" in f}
    assert closed and closed <= seen[2]
    assert rows(state["s_users"].where("user_id_dwh = 'u1'").select("user_name", F.col("active_to").cast("string"))) == [
        ("a", "2024-01-02 09:59:59.999"), ("a", OPEN_TO), ("a2", "2024-01-03 09:59:59.999")]


def test_bonus_events_are_cut_by_their_typed_date(spark):
    event = '{"order_id": "1", "order_date": "%s 10:00:00", "product_payments": [{"product_id": "p", "bonus_payment": 1.0, "bonus_grant": 2.0}]}'
    events = spark.createDataFrame([("bonus_transaction", event % "2024-01-05"), ("bonus_transaction", event % "2024-01-04"),
                                    ("other", "not json"), ("bonus_transaction", None)], "event_type string, event_value string")
    staged = save_table(to_outbox(events.withColumn("event_ts", ts_lit("2024-01-06 00:00:00"))), shared_dir(spark, "test-outbox"), "o")
    found = shred.shred_bonuses(staged, "2024-01-05")
    assert rows(found, "order_id", "product_id") == [("1", "p")]
    assert rows(found) == rows(shred.shred_bonuses(staged.drop("order_date"), "2024-01-05"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "GreaterThanOrEqual(order_date,2024-01-05)" in found._jdf.queryExecution().explainString(mode)
