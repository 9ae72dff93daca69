import datetime as dt
import glob

import pytest

from tests.conftest import rows
from vaultspark.session import shared_dir
from vaultspark.sources.ingest import land_json
from vaultspark.streaming import stage_documents_stream
from vaultspark.streaming import documents
from vaultspark.streaming.documents import load_batch, read_stage

SRC = "_id string, name string, update_ts timestamp_ntz"


def test_stream_runs_stage_new_files_only_and_skip_stale_documents(spark):
    base = shared_dir(spark, "test-stream")
    landing, root, ckpt = f"{base}/landing", f"{base}/stage", f"{base}/ckpt"
    T = dt.datetime
    land_json(spark.createDataFrame([("1", "a", T(2024, 1, 1)), ("2", "b", T(2024, 1, 1, 5))], SRC),
              f"{landing}/drop=0")
    e0 = stage_documents_stream(spark, f"{landing}/drop=*", spark.createDataFrame([], SRC).schema, root, ckpt,
                                "order_system_users")
    # second drop: a newer version of 1, and a document older than the watermark (skipped, as the source query does)
    land_json(spark.createDataFrame([("1", "a2", T(2024, 1, 2)), ("3", "old", T(2024, 1, 1, 1))], SRC),
              f"{landing}/drop=1")
    e1 = stage_documents_stream(spark, f"{landing}/drop=*", spark.createDataFrame([], SRC).schema, root, ckpt,
                                "order_system_users")
    assert (e0, e1) == (0, 1)
    stage = read_stage(spark, root, "order_system_users")
    assert rows(stage, "object_id", "update_ts") == [("1", T(2024, 1, 2)), ("2", T(2024, 1, 1, 5))]
    # a run with no new files writes nothing
    assert stage_documents_stream(spark, f"{landing}/drop=*", spark.createDataFrame([], SRC).schema, root, ckpt,
                                  "order_system_users") is None


def _users(spark, *items):
    return spark.createDataFrame([(k, n, dt.datetime(2024, 1, d, h)) for k, n, d, h in items], SRC)


def _batch_files(root):
    return set(glob.glob(f"{root}/order_system_users/**/*.parquet", recursive=True))


def test_a_batch_rewrites_only_its_days(spark):
    root = shared_dir(spark, "test-stream-days")
    assert read_stage(spark, root, "order_system_users").isEmpty()
    load_batch(_users(spark, ("1", "a", 1, 1), ("2", "b", 2, 1), ("3", "c", 3, 1)), "q", 0, root, "order_system_users")
    before = _batch_files(root)
    load_batch(_users(spark, ("2", "b2", 4, 1), ("9", "late", 1, 2)), "q", 1, root, "order_system_users")
    after = _batch_files(root)
    assert {f.split("part_day=")[1][:10] for f in after - before} <= {"2024-01-02", "2024-01-04"}
    assert {f for f in before if "2024-01-01" in f or "2024-01-03" in f} <= after
    assert rows(read_stage(spark, root, "order_system_users"), "object_id", "update_ts") == [
        ("1", dt.datetime(2024, 1, 1, 1)), ("2", dt.datetime(2024, 1, 4, 1)), ("3", dt.datetime(2024, 1, 3, 1))]


def test_a_batch_stopped_between_its_writes_is_completed(spark, monkeypatch):
    """The stage is written, the ledger is not: the retry gives the same stage, and one after the ledger is skipped."""
    root = shared_dir(spark, "test-stream-retry")
    load_batch(_users(spark, ("1", "a", 1, 1), ("2", "b", 1, 2)), "q", 0, root, "order_system_users")
    batch = _users(spark, ("1", "a2", 2, 1), ("3", "c", 2, 1), ("4", "stale", 1, 1))
    upsert = documents.upsert_days

    def stopped(*args):
        upsert(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(documents, "upsert_days", stopped)
    with pytest.raises(RuntimeError):
        load_batch(batch, "q", 1, root, "order_system_users")
    monkeypatch.undo()
    half = rows(read_stage(spark, root, "order_system_users"))
    assert load_batch(batch, "q", 1, root, "order_system_users")
    assert rows(read_stage(spark, root, "order_system_users")) == half and len(half) == 3
    assert not load_batch(_users(spark, ("7", "never", 9, 1)), "q", 1, root, "order_system_users")
    with pytest.raises(RuntimeError, match="follows batch 1"):
        load_batch(batch, "q", 3, root, "order_system_users")
    # a query with a checkpoint of its own counts its batches from 0 and goes on from the same watermark
    assert load_batch(_users(spark, ("5", "e", 3, 1), ("6", "old", 2, 1)), "other", 0, root, "order_system_users")
    assert [r[0] for r in rows(read_stage(spark, root, "order_system_users"), "object_id")] == ["1", "2", "3", "5"]
