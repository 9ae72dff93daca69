"""Day tables with moved orders, buckets of open versions, and restarts from what a run left on disk."""

import datetime as dt
import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_replay import DAYS, LO, TABLES, changing_sources
from vaultspark.functions.time import OPEN_TO, ts_lit
from vaultspark.operators import vault
from vaultspark.plans import pipeline
from vaultspark.schemas import TABLES as SCHEMAS
from vaultspark.session import shared_dir
from vaultspark.sources import store

HI = LO + dt.timedelta(days=DAYS - 1)


def _files(root):
    return {f for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def _spoil(files):
    """Any scan of these files fails from now on."""
    for f in files:
        os.remove(f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc")
        with open(f, "wb") as out:
            out.write(b"no parquet")


@pytest.fixture(scope="module")
def sources(spark):
    return changing_sources(spark, 4)


@pytest.fixture(scope="module")
def plain(spark, sources):
    state = pipeline.run_days(pipeline.empty_state(spark), sources, LO, HI, shared_dir(spark, "test-plain-loop"))
    return {t: rows(state[t]) for t in TABLES}


def test_a_stopped_run_is_finished_from_its_folder(spark, sources, plain, monkeypatch):
    """A run fails after its staging and hubs are written; a later call goes on from the folder alone."""
    root, calls = shared_dir(spark, "test-recovery"), []

    def broken(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("executor lost")
        return link(*args)

    link = vault.link_changes
    monkeypatch.setattr(vault, "link_changes", broken)
    with pytest.raises(RuntimeError):
        pipeline.resume_days(spark, sources, root, LO, HI, open_buckets=4)
    state, names, last = pipeline.load_state(spark, root)
    assert last == LO + dt.timedelta(days=1) and set(names) >= {"l_orders", "h_orders", "order_moves"}
    done = pipeline.resume_days(spark, sources, root, LO, HI)
    assert {t: rows(done[t]) for t in TABLES} == plain  # and day tables = whole versions, for orders that move
    again = pipeline.resume_days(spark, sources, root, LO, HI)
    assert len(calls) == DAYS + 1 and {t: rows(again[t]) for t in TABLES} == plain
    ledger = store.read_ledger(spark, root)
    assert ledger.select("run_id").distinct().count() == DAYS + 1  # the first load and every finished run
    code = (f"from vaultspark.session import get_session; from vaultspark.plans import pipeline; s, n, d = pipeline.load_state(get_session('local[2]', 2), {root!r}); "
            "print('STATE', d, *(s[t].count() for t in ('l_orders', 's_users', 'load_watermarks', 'order_system_users')))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    want = [again[t].count() for t in ("l_orders", "s_users", "load_watermarks", "order_system_users")]
    assert f"STATE {HI} {' '.join(map(str, want))}" in out.stdout, out.stderr[-500:]


def test_chunked_backfill_and_runs_agree(spark, sources, plain):
    done = pipeline.resume_days(spark, sources, shared_dir(spark, "test-chunks"), LO, HI, chunk=2)
    assert {t: rows(done[t]) for t in TABLES} == plain


def test_nothing_on_disk_is_an_empty_state(spark):
    state, names, last = pipeline.load_state(spark, shared_dir(spark, "test-nothing"))
    assert last is None and names == {} and state["l_orders"].isEmpty()


def _link(spark, *items):
    return spark.createDataFrame([(k, "r", "u", None, "p", 1, None, None, dt.date(2024, 1, d)) for k, d in items],
                                 "order_id_dwh string, restaurant_id_dwh string, user_id_dwh string, courier_id_dwh string, product_id_dwh string, "
                                 "quantity int, bonus_payment decimal(8,2), bonus_grant decimal(8,2), day date")


def test_link_rewrite_reads_only_the_days_it_is_told(spark):
    root = shared_dir(spark, "test-feed")
    table, moves = store.day_table(spark, root, "l_orders"), store.moves_table(spark, root)
    store.load_days(spark, table, "l_orders", _link(spark, ("a", 1), ("b", 2), ("c", 3), ("d", 4)), "day")
    moved = spark.createDataFrame([("a", dt.date(2024, 1, 1), dt.date(2024, 1, 4)), ("c", dt.date(2024, 1, 3), dt.date(2024, 1, 9))],
                                  "object_id string, old_day date, new_day date")
    store.append_moves(spark, moves, moved, "2024-01-04")
    stage = spark.createDataFrame([("a", dt.date(2024, 1, 4)), ("d", dt.date(2024, 1, 4)), ("b", dt.date(2024, 1, 2)), ("n", None)], "object_id string, order_date date")
    held = pipeline.days_of_orders(stage, spark.table(moves), "2024-01-04", 0)
    assert sorted(str(r[0]) for r in held.collect()) == ["2024-01-01", "2024-01-04"]
    before = _files(f"{root}/l_orders")
    others = {f for f in before if "2024-01-02" in f or "2024-01-03" in f}
    _spoil(others)
    new = _link(spark, ("a", 4), ("d", 4))
    store.rewrite_days(spark, table, "l_orders", new, ["order_id_dwh"], new, "day", held)
    assert rows(spark.table(table).where("part_day in (DATE'2024-01-01', DATE'2024-01-04')").select("order_id_dwh", F.col("part_day").cast("string"))) == [
        ("a", "2024-01-04"), ("d", "2024-01-04")]
    assert others <= _files(f"{root}/l_orders")


def test_staging_feeds_the_moves_of_every_run(spark):
    root, name = shared_dir(spark, "test-moves"), "order_system_orders"
    table, moves = store.day_table(spark, root, name), store.moves_table(spark, root)
    day = dt.date
    for run, batch in (("2024-01-01", [("1", day(2024, 1, 1)), ("2", None), ("3", day(2024, 1, 1))]),
                       ("2024-01-02", [("1", day(2024, 1, 5)), ("2", day(2024, 1, 2)), ("3", day(2024, 1, 1))]),
                       ("2024-01-03", [("1", None)])):
        df = spark.createDataFrame([(k, "{}", dt.datetime.fromisoformat(run), d) for k, d in batch], SCHEMAS[name])
        for _ in range(2):  # a repeated run keeps what its first attempt noted
            store.upsert_days(spark, table, name, df, ["object_id"], "update_ts", "order_date", moves, run)
    got = rows(spark.table(moves).selectExpr("object_id", "cast(old_day as string)", "cast(new_day as string)", "cast(part_day as string)"))
    assert got == sorted([("1", "2024-01-01", "2024-01-05", "2024-01-02"), ("2", None, "2024-01-02", "2024-01-02"),
                          ("1", "2024-01-05", None, "2024-01-03")], key=repr)


def test_one_changed_key_reads_and_writes_one_bucket(spark, monkeypatch):
    root, buckets = shared_dir(spark, "test-buckets"), 8
    state = pipeline.empty_state(spark)
    first = [(f"u{i}", f"name {i}", "x", dt.datetime(2024, 1, 1), dt.datetime.fromisoformat(OPEN_TO)) for i in range(64)]
    state["s_users"] = spark.createDataFrame(first, SCHEMAS["s_users"])
    state, names = pipeline.register_day_tables(state, root, load=True, open_buckets=buckets)
    before = _files(f"{root}/s_users")
    assert len({f.split("part_bucket=")[1].split("/")[0] for f in before}) == buckets
    change = spark.createDataFrame([("u5", "new name", "x")], "user_id_dwh string, user_name string, user_login string")
    monkeypatch.setattr(pipeline, "user_batch", lambda *_: change.withColumn("update_ts", ts_lit("2024-01-02 10:00:00")))
    hit = spark.range(1).select(F.lit("u5").alias("k")).select(store.bucket_of("k", buckets)).first()[0]
    others = {f for f in before if f"part_bucket={hit}/" not in f}
    _spoil(others)
    pipeline.run_dependents(state, "2024-01-02", day_tables=names)
    after = _files(f"{root}/s_users")
    assert others <= after
    assert {tuple(f.split("part_day=")[1].split("/")[:2]) for f in after - before} == {
        ("2099-12-01", f"part_bucket={hit}"), ("2024-01-02", "part_bucket=0")}
    seen = spark.table(names["s_users"]).where(f"part_bucket in (0, {hit})").where("user_id_dwh = 'u5'")
    seen = seen.where((F.col("part_day") < "2099-01-01") | (F.col("part_bucket") == hit))
    assert rows(seen.select("user_name", F.col("active_to").cast("string"))) == [("name 5", "2024-01-02 09:59:59.999"), ("new name", OPEN_TO)]


def test_hubs_are_joined_as_they_lie(spark):
    """With broadcasts off, the batch is shuffled to the hub's buckets; nothing is exchanged above the hub's scan."""
    root = shared_dir(spark, "test-hubs")
    table = store.append_table(spark, root, "h_users", "user_id_bk", 8)
    keys = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("user_id_dwh"), F.col("id").cast("string").alias("user_id_bk"))
    store.load_rows(spark, table, "h_users", keys.where("id < 900"))
    hub = store.append_rows_to(spark, table, "h_users", keys.where("id >= 900"))
    assert len(_files(f"{root}/h_users")) == 16
    batch = spark.range(0, 2000, 3).select(F.col("id").cast("string").alias("object_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, want in ((vault.new_keys(hub, batch, "object_id", "user"), 333),
                         (batch.join(vault._hub_as(hub, "user", "object_id"), "object_id"), 334)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 2
            for part in plan.split("Exchange hashpartitioning")[1:]:  # below every exchange lies the batch, never the hub
                assert "FileScan" not in part.split("SortMergeJoin")[0].split("Exchange")[0] or "Bucketed" not in part.split("Range")[0]
            assert df.count() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
