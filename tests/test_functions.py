import datetime as dt

from pyspark.sql import functions as F

from vaultspark.functions import changed, in_days, local_day, minus_one_ms, new_or_changed


def test_changed_three_valued(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "n string, o string")
    out = df.select(F.coalesce(changed([F.col("n")], [F.col("o")]), F.lit(False)).alias("c"),
                    changed([F.col("n")], [F.col("o")], null_safe=True).alias("s")).collect()
    assert [r.c for r in out] == [False, True, False, False]  # NULL is no change by default
    assert [r.s for r in out] == [False, True, True, False]


def test_new_or_changed_marker(spark):
    df = spark.createDataFrame([("a", None, None)], "n string, o string, hit boolean")
    r = df.select(new_or_changed([F.col("n")], [F.col("o")], F.col("hit")).alias("x")).first()
    assert r.x is True


def test_minus_one_ms(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 0, 0),)], "ts timestamp_ntz")
    assert df.select(minus_one_ms("ts").alias("t")).first().t == dt.datetime(2024, 1, 1, 23, 59, 59, 999000)


def test_local_day_moscow_border(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 4, 20, 59, 59),), (dt.datetime(2024, 1, 4, 21, 0, 0),)],
                               "ts timestamp_ntz")
    assert [r.d for r in df.select(local_day("ts").alias("d")).collect()] == [dt.date(2024, 1, 4),
                                                                              dt.date(2024, 1, 5)]


def test_in_days_is_inclusive_by_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 23, 59, 59),), (dt.datetime(2024, 1, 4, 0, 0),),
                                (dt.datetime(2024, 1, 5, 23, 59, 59, 999999),), (dt.datetime(2024, 1, 6),)],
                               "ts timestamp_ntz")
    assert df.where(in_days("ts", "2024-01-04", "2024-01-05")).count() == 2
