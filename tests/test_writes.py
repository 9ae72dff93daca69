import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vaultspark.operators import writes
from vaultspark.session import shared_dir
from vaultspark.sources import ingest

DOC = "object_id string, object_value string, update_ts timestamp_ntz"
T = dt.datetime


def test_upsert_newest_wins_and_ties_are_deterministic(spark):
    target = spark.createDataFrame([("1", "old", T(2024, 1, 1)), ("2", "keep", T(2024, 1, 1))], DOC)
    batch = spark.createDataFrame([("1", "a", T(2024, 1, 2)), ("1", "b", T(2024, 1, 3)),
                                   ("3", "x", T(2024, 1, 3)), ("3", "y", T(2024, 1, 3))], DOC)
    out = writes.upsert(target, batch, ["object_id"])
    assert rows(out) == [("1", "b", T(2024, 1, 3)), ("2", "keep", T(2024, 1, 1)), ("3", "y", T(2024, 1, 3))]
    assert rows(writes.upsert(out, batch, ["object_id"])) == rows(out)  # rerun-safe


def test_upsert_empty_batch_and_empty_target(spark):
    empty = spark.createDataFrame([], DOC)
    target = spark.createDataFrame([("1", "v", T(2024, 1, 1))], DOC)
    assert rows(writes.upsert(target, empty, ["object_id"])) == rows(target)
    assert rows(writes.upsert(empty, target, ["object_id"])) == rows(target)


def test_insert_absent_existing_key_wins(spark):
    hub = spark.createDataFrame([("h1", "1")], "k_dwh string, k string")
    batch = spark.createDataFrame([("x", "1"), ("h2", "2"), ("h2", "2")], "k_dwh string, k string")
    out = writes.insert_absent(hub, batch, ["k"])
    assert rows(out) == [("h1", "1"), ("h2", "2")]


def test_replace_slice_and_range_rerun_safe(spark):
    schema = "v string, ts timestamp_ntz"
    target = spark.createDataFrame([("a", T(2024, 1, 4)), ("b", T(2024, 1, 5, 10)), ("n", None)], schema)
    batch = spark.createDataFrame([("c", T(2024, 1, 5, 1)), ("other-day", T(2024, 1, 6))], schema)
    once = writes.replace_slice(target, batch, "ts", "2024-01-05")
    assert rows(once) == rows(writes.replace_slice(once, batch, "ts", "2024-01-05"))
    assert sorted(r.v for r in once.collect()) == ["a", "c", "n"]
    rng = writes.replace_range(target, batch, "ts", "2024-01-04", "2024-01-05")
    assert sorted(r.v for r in rng.collect()) == ["c", "n"]


def test_delete_keys_and_update_from(spark):
    target = spark.createDataFrame([("1", "x", 1), ("2", "y", 1), ("3", "z", 0)], "k string, a string, open int")
    keys = spark.createDataFrame([("2",)], "k string")
    assert sorted(r.k for r in writes.delete_keys(target, keys, ["k"]).collect()) == ["1", "3"]
    upd = spark.createDataFrame([("1", "new"), ("3", "new")], "k string, a2 string")
    out = writes.update_from(target, upd, ["k"], {"a": F.col("a2")}, where=F.col("open") == 1)
    assert rows(out) == [("1", "new", 1), ("2", "y", 1), ("3", "z", 0)]


def test_watermark_missing_tie_and_advance(spark):
    log = spark.createDataFrame([("orders", T(2024, 1, 2))], "table_name string, update_ts timestamp_ntz")
    wms = {r.table_name: r.high_watermark for r in ingest.high_watermarks(log, ["orders", "users"]).collect()}
    assert wms == {"orders": T(2024, 1, 2), "users": T(1900, 1, 1)}
    src = spark.createDataFrame([("1", T(2024, 1, 2)), ("2", T(2024, 1, 3))], "id string, update_ts timestamp_ntz")
    got = ingest.incremental_scan(src, ingest.high_watermark(log, "orders"))
    assert [r.id for r in got.collect()] == ["2"]  # a tie with the watermark is skipped
    stage = spark.createDataFrame([("1", "{}", T(2024, 1, 3))], DOC)
    assert writes.advance_watermark(log, stage, "orders").count() == 2
    assert writes.advance_watermark(log, stage.limit(0), "orders").count() == 1  # empty stage: nothing
    assert writes.advance_watermark(log, stage.where("update_ts < '2024-01-02'"), "orders").count() == 1


def test_landed_json_binds_by_name(spark):
    from vaultspark.schemas import STAGING

    df = spark.createDataFrame([("Anna", "7")], "name string, _id string")  # other field order
    path = ingest.land_json(df, shared_dir(spark, "test-couriers"))
    got = ingest.read_landed_json(spark, path, STAGING["couriers_system_couriers"])
    assert got.columns == ["_id", "name"] and rows(got) == [("7", "Anna")]


def test_replace_all(spark):
    t = spark.createDataFrame([("1", "a"), ("1", "a")], "_id string, name string")
    b = spark.createDataFrame([("2", "b")], "_id string, name string")
    assert rows(writes.replace_all(t, b)) == [("2", "b")]


@pytest.mark.parametrize("bad", ["not json", '{"menu": [{"_id": 1,}]}'])
def test_malformed_json_fails(spark, bad):
    from vaultspark.operators.shred import menu_product_keys

    stage = spark.createDataFrame([("1", bad, T(2024, 1, 1))], DOC)
    with pytest.raises(Exception):
        menu_product_keys(stage, None).collect()


def test_save_table_observes_rows_written(spark):
    from vaultspark.sources.store import save_table

    metrics = {}
    out = save_table(spark.range(123).toDF("id"), shared_dir(spark, "test-store"), "t", metrics=metrics)
    assert metrics == {"t": 123} and out.count() == 123


def test_sequence_keys_dense_after_max_in_key_order(spark):
    from vaultspark.operators import vault

    hub = spark.createDataFrame([(1, "b"), (2, "d")], "order_id_dwh bigint, order_id_bk string")
    batch = spark.range(0, 200, numPartitions=7).selectExpr("lpad(cast(id as string), 4, '0') AS object_id") \
        .union(spark.createDataFrame([("b",), ("d",), ("zz",)], "object_id string"))
    out = vault.load_hub(hub, batch, "object_id", "order", key="sequence")
    got = sorted((r.order_id_dwh, r.order_id_bk) for r in out.collect())
    new = [g for g in got if g[0] > 2]
    assert [k for k, _ in new] == list(range(3, 3 + 201))  # dense, no gaps, after the maximum
    assert [b for _, b in new] == sorted(b for _, b in new)  # numbered in business-key order
    assert got[:2] == [(1, "b"), (2, "d")]  # existing keys keep theirs
