import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from vaultspark.functions.time import OPEN_TO
from vaultspark.operators import scd2

SAT = "k string, name string, active_from timestamp_ntz, active_to timestamp_ntz"
BATCH = "k string, name string, update_ts timestamp_ntz"
OPEN = dt.datetime.fromisoformat(OPEN_TO)
MS = dt.timedelta(milliseconds=1)


def d(n, h=0):
    return dt.datetime(2024, 1, n, h)


def apply(sat, batch, **kw):
    return scd2.scd2_apply(sat, batch, "k", ["name"], **kw)


def apply_day(sat, batch):
    """A day of a chain: persisted (reliable checkpoint), as the pipeline persists each day,
    so the next day's plan starts from files instead of embedding the previous plans."""
    return apply(sat, batch).checkpoint(eager=True)


def test_a_b_a_gives_three_versions_one_open(spark):
    sat = spark.createDataFrame([], SAT)
    for day, name in ((1, "A"), (2, "B"), (3, "A")):
        sat = apply_day(sat, spark.createDataFrame([("1", name, d(day))], BATCH))
    assert rows(sat) == sorted([("1", "A", d(1), d(2) - MS), ("1", "A", d(3), OPEN), ("1", "B", d(2), d(3) - MS)],
                               key=repr)


def test_unchanged_rerun_adds_nothing(spark):
    batch = spark.createDataFrame([("1", "A", d(1)), ("2", "B", d(1))], BATCH)
    once = apply(spark.createDataFrame([], SAT), batch)
    assert rows(apply(once, batch)) == rows(once)


def test_null_change_is_not_a_change_unless_null_safe(spark):
    sat = spark.createDataFrame([("1", "a", d(1), OPEN)], SAT)
    batch = spark.createDataFrame([("1", None, d(2))], BATCH)
    assert rows(apply(sat, batch)) == rows(sat)
    out = apply(sat, batch, null_safe=True)
    assert rows(out) == sorted([("1", None, d(2), OPEN), ("1", "a", d(1), d(2) - MS)], key=repr)


def test_first_version_with_null_attribute_is_emitted(spark):
    out = apply(spark.createDataFrame([], SAT), spark.createDataFrame([("1", None, d(1))], BATCH))
    assert rows(out) == [("1", None, d(1), OPEN)]


def test_same_key_twice_in_batch_newest_then_attributes(spark):
    sat = spark.createDataFrame([], SAT)
    out = apply(sat, spark.createDataFrame([("1", "x", d(1, 1)), ("1", "y", d(1, 2))], BATCH))
    assert rows(out) == [("1", "y", d(1, 2), OPEN)]
    out = apply(sat, spark.createDataFrame([("1", "x", d(1)), ("1", "y", d(1))], BATCH))
    assert rows(out) == [("1", "y", d(1), OPEN)]


def test_older_update_after_newer_is_kept_and_detectable(spark):
    sat = spark.createDataFrame([("1", "a", d(5), OPEN)], SAT)
    out = apply(sat, spark.createDataFrame([("1", "b", d(3))], BATCH))
    from vaultspark.operators.quality import check, ordered

    bad = check(out, [ordered("active_from", "active_to")]).where(F.col("rule").isNotNull())
    assert bad.count() == 1  # reported by a check, not altered


def test_one_plan_equals_close_then_insert(spark):
    sat = spark.createDataFrame([("1", "a", d(1), OPEN), ("2", "b", d(1), OPEN)], SAT)
    batch = spark.createDataFrame([("1", "a2", d(2)), ("2", "b", d(2)), ("3", "c", d(2))], BATCH)
    two_step = scd2.scd2_insert(scd2.scd2_close(sat, batch, "k", ["name"]), batch, "k", ["name"])
    assert rows(apply(sat, batch)) == rows(two_step)


def test_at_most_one_open_version_and_no_overlap(spark):
    sat = spark.createDataFrame([], SAT)
    for day in range(1, 6):
        b = spark.createDataFrame([(str(k), f"n{(k * day) % 3}", d(day, k)) for k in range(6)], BATCH)
        sat = apply_day(sat, b)
    assert sat.where(F.col("active_to") == F.lit(OPEN)).groupBy("k").count().where("count > 1").count() == 0
    a, b = sat.alias("a"), sat.alias("b")
    overlap = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.active_from") < F.col("b.active_from"))
                     & (F.col("b.active_from") <= F.col("a.active_to")))
    assert overlap.count() == 0


def test_history_equals_day_loop(spark):
    updates = [(str(k), f"n{(k + day) % 2 if k % 2 else 0}", d(day, k)) for day in range(1, 5) for k in range(5)]
    sat = spark.createDataFrame([], SAT)
    for day in range(1, 5):
        sat = apply_day(sat, spark.createDataFrame([u for u in updates if u[2].day == day], BATCH))
    hist = scd2.scd2_history(spark.createDataFrame(updates, BATCH), "k", ["name"])
    assert rows(hist) == rows(sat)
