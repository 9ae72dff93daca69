"""Day tables: undated and moved rows, restarts, empty tables; shared folder decision; SCD2 fold; backfill versions."""

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vaultspark import session
from vaultspark.operators import scd2, writes
from vaultspark.plans import pipeline
from vaultspark.schemas import TABLES
from vaultspark.session import shared_dir
from vaultspark.sources import store

NAME = "order_system_orders"
D = dt.date


def _orders(spark, *items):
    return spark.createDataFrame([(k, "{}", dt.datetime(2024, 1, v), d) for k, v, d in items], TABLES[NAME])


def test_day_upsert_keeps_undated_and_moved_orders(spark):
    table = store.day_table(spark, shared_dir(spark, "t-undated"), NAME)
    first = _orders(spark, ("1", 1, None), ("2", 1, D(2024, 1, 1)), ("3", 1, None), ("4", 1, D(2024, 1, 2)))
    second = _orders(spark, ("2", 2, None), ("3", 2, D(2024, 1, 1)), ("4", 2, D(2024, 1, 5)), ("5", 2, None))
    third = _orders(spark, ("1", 3, D(2024, 1, 1)), ("2", 3, D(2024, 1, 1)), ("5", 3, D(2024, 1, 1)))
    plain = store.empty_table(spark, NAME)
    for batch in (first, second, third):  # the third leaves no undated order
        plain = writes.upsert(plain, batch, ["object_id"], "update_ts")
        by_day = store.upsert_days(spark, table, NAME, batch, ["object_id"], "update_ts", "order_date")
        assert rows(by_day) == rows(plain)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_day_tables_are_read_in_a_new_process(spark):
    root = shared_dir(spark, "t-restart")
    table = store.day_table(spark, root, NAME)
    store.load_days(spark, table, NAME, _orders(spark, ("1", 1, None), ("2", 1, D(2024, 1, 1))), "order_date")
    code = (f"from vaultspark.session import get_session; from vaultspark.sources import store; s = get_session('local[2]', 2); "
            f"print('ROWS', store.read_days(s, store.day_table(s, {root!r}, {NAME!r}), {NAME!r}).count())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert "ROWS 2" in out.stdout, out.stderr[-500:]


def test_saved_table_without_rows_has_its_schema(spark):
    got = store.save_table(store.empty_table(spark, NAME), shared_dir(spark, "t-empty"), NAME, ["order_date"])
    assert got.count() == 0 and set(got.columns) == set(TABLES[NAME].fieldNames())


@pytest.mark.parametrize("master,local", [("local", True), ("local[8]", True), ("local[*,3]", True), ("yarn", False),
                                          ("local-cluster[3,2,3000]", False), ("spark://h:7077", False), ("k8s://x", False)])
def test_local_folder_only_for_one_process(master, local):
    assert session.single_jvm(master) is local


def test_history_keeps_versions_across_nulls(spark):
    T = dt.datetime
    ups = spark.createDataFrame([("k", v, T(2024, 1, i)) for i, v in enumerate(["a", None, "b", "b", None, "a"], 1)],
                                "id string, name string, update_ts timestamp_ntz")
    sat = spark.createDataFrame([], "id string, name string, active_from timestamp_ntz, active_to timestamp_ntz")
    for day in range(1, 7):
        sat = scd2.scd2_apply(sat, ups.where(F.dayofmonth("update_ts") == day), "id", ["name"])
        sat = spark.createDataFrame(sat.collect(), sat.schema)  # a day's plan does not hold those before it
    got = scd2.scd2_history(ups, "id", ["name"])
    assert rows(got, "id", "name", "active_from", "active_to") == rows(sat, "id", "name", "active_from", "active_to")
    assert got.count() == 3


def test_backfill_uses_the_newest_version_of_a_day(spark):
    docs = spark.createDataFrame([("r", "old", dt.datetime(2024, 1, 1, 5)), ("r", "new", dt.datetime(2024, 1, 1, 9)),
                                  ("r", "next", dt.datetime(2024, 1, 2))], "object_id string, object_value string, update_ts timestamp_ntz")
    assert [r[1] for r in rows(pipeline._newest_of_day(docs))] == ["new", "next"]
