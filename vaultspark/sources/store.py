"""Table store.

Snapshot tables: one folder per table, a new version folder per save.  A save
never overwrites a folder that the same plan may still read; the new version is
written next to the old one and returned as a fresh scan (which also cuts the
lineage of multi-day loops).

Day tables: for tables that a run replaces by day (outbox, deliveries), a
catalog table partitioned by day, stored under the shared folder.  Replacing a
day overwrites only that day's partition (``INSERT OVERWRITE .. PARTITION``), so
the cost of a run does not grow with the table's history.  Spark refuses to
overwrite a table that the same plan reads, which keeps these writes safe.

Versioned day tables: the open versions, which have no end day, are one day
partition cut into buckets by the hash of their key, so that a run rewrites only
the buckets of the keys it changes.

Where the rows that a load deletes may lie is either looked up in the table (the
staged orders) or known beforehand: from the key's bucket, or from the feed of
moved orders that staging leaves (``moves_table``).
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import datetime as dt
import hashlib

from vaultspark.functions.time import DayLike, in_days
from vaultspark.schemas import BOOKKEEPING, TABLES

SCHEMAS = TABLES | BOOKKEEPING


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """Declared table with no rows (``CREATE TABLE IF NOT EXISTS`` of a missing table)."""
    return spark.createDataFrame([], TABLES[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of the declared table, in its order and types (ANSI casts)."""
    schema = SCHEMAS[name]
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def save_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
               metrics: dict[str, int] | None = None, paths: dict[str, str] | None = None) -> DataFrame:
    """Write a new version of table ``name`` under ``root`` and return it as a scan.

    With ``metrics``, the number of rows written is recorded as ``metrics[name]``;
    it is counted by an observation on the write itself, not by a second scan.  With ``paths`` the version's folder
    is recorded as ``paths[name]``.
    """
    path = f"{root.rstrip('/')}/{name}/v={time.time_ns()}-{uuid.uuid4().hex[:8]}"
    obs = None
    if metrics is not None:
        obs = Observation(f"rows_{name}_{uuid.uuid4().hex[:6]}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode("errorifexists")
    if partition_by:
        w = df.hint("rebalance", *partition_by).write.mode("errorifexists")  # a day's rows together, large days split
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if obs is not None:
        metrics[name] = _sum_of(obs, "rows")
    if paths is not None:
        paths[name] = path
    return load_table(df.sparkSession, path, df.schema)


def load_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved version with its declared schema (a version without rows has no file to infer it from)."""
    return spark.read.schema(schema).parquet(path)


DAY_COL, BUCKET_COL = "part_day", "part_bucket"


def path_exists(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


Changes = dict[str, dict[str, int]]  # table -> rows added, removed


def _note(changes: Changes | None, name: str, added: int, removed: int) -> None:
    """Add a write's rows to what a run changed in a table."""
    if changes is not None:
        was = changes.setdefault(name, {"added": 0, "removed": 0})
        was["added"] += added
        was["removed"] += removed


def _observed(df: DataFrame, **sums: Column) -> tuple[DataFrame, Observation]:
    """``df`` with sums that the action on it brings along."""
    seen = Observation(f"rows_{uuid.uuid4().hex[:10]}")
    return df.observe(seen, *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in sums.items()]), seen


def _sum_of(seen: Observation, name: str) -> int:
    try:
        return int(seen.get[name])
    except Py4JJavaError:  # a plan that the optimizer knows to be empty brings no sums along
        return 0


def _table_name(location: str, name: str) -> str:
    return f"{name}_{hashlib.sha1(location.encode()).hexdigest()[:10]}"


def day_table(spark: SparkSession, root: str, name: str, buckets: int = 0) -> str:
    """Register (idempotently) the day-partitioned catalog table of ``name`` stored at ``root/name``; with ``buckets`` days
    are cut further by ``BUCKET_COL``, and the number is kept as a property of the table.

    Partitions already on disk are recovered, so a session with a catalog of its own sees them.  Overwrites
    without a stated partition replace only the days they write (a property of the table, not of the session).
    """
    location = f"{root.rstrip('/')}/{name}"
    table = _table_name(location, name)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[name].fields)
    if not spark.catalog.tableExists(table):
        more, by = (f", {BUCKET_COL} INT", f"{DAY_COL}, {BUCKET_COL}") if buckets else ("", DAY_COL)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, {DAY_COL} DATE{more}) USING parquet "
                  f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({by}) LOCATION '{location}' "
                  f"TBLPROPERTIES ('{BUCKET_COL}s' = '{buckets}')")
        if path_exists(spark, location):
            spark.catalog.recoverPartitions(table)
    return table


def table_buckets(spark: SparkSession, table: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{BUCKET_COL}s')").first()["value"])


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def append_ledger(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Add the rows of a finished run (``run_ledger``: one a table) in one file, so that all of them appear or none."""
    spark.createDataFrame(rows, SCHEMAS["run_ledger"]).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/run_ledger")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every finished run under ``root``; no rows where none has finished yet."""
    path = f"{root.rstrip('/')}/run_ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMAS["run_ledger"])
    return load_table(spark, path, SCHEMAS["run_ledger"])


def moves_table(spark: SparkSession, root: str) -> str:
    """Register the feed of moved orders (``order_moves``, by run day)."""
    return day_table(spark, root, "order_moves")


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of an open version's key (runs must agree on ``buckets``; the run ledger keeps it)."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def with_buckets(rows: DataFrame, key: str, is_open: Column, buckets: int) -> DataFrame:
    """``rows`` with their bucket: that of the key for open versions, 0 for ended ones."""
    return rows.withColumn(BUCKET_COL, F.when(is_open, bucket_of(key, buckets)).otherwise(F.lit(0)))


def _with_day(df: DataFrame, name: str, day_source: str) -> DataFrame:
    """Declared columns of ``name`` plus the layout day taken from ``df[day_source]``, and the bucket where ``df`` has one."""
    schema = SCHEMAS[name]
    more = [df[BUCKET_COL]] if BUCKET_COL in df.columns else []
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields],
                     F.to_date(df[day_source]).alias(DAY_COL), *more)


def _parts(df: DataFrame) -> list[str]:
    return [c for c in (DAY_COL, BUCKET_COL) if c in df.columns]


def _view(df: DataFrame) -> str:
    name = f"_vs_batch_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def _overwrite_present_days(spark: SparkSession, table: str, parts: list[str], select_sql: str) -> None:
    """Replace only the partitions the query returns (rows without a day are a partition of their own)."""
    by = ", ".join(parts)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({by}) SELECT /*+ REBALANCE({by}) */ * FROM ({select_sql})")


def read_days(spark: SparkSession, table: str, name: str) -> DataFrame:
    """The table's rows in the declared columns (the day column is only layout)."""
    return spark.table(table).select(*SCHEMAS[name].fieldNames())


def load_days(spark: SparkSession, table: str, name: str, df: DataFrame, ts: str, changes: Changes | None = None) -> DataFrame:
    """Bulk load: overwrite every partition present in ``df`` (others are kept)."""
    content, seen = _observed(_with_day(df, name, ts), added=F.lit(1))
    view = _view(content)
    _overwrite_present_days(spark, table, _parts(content), f"SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    _note(changes, name, _sum_of(seen, "added"), 0)
    return read_days(spark, table, name)


def replace_days(spark: SparkSession, table: str, name: str, batch: DataFrame, ts: str,
                 lo: DayLike, hi: DayLike | None = None, changes: Changes | None = None) -> DataFrame:
    """Replace days ``lo..hi`` with the batch's rows of those days; other partitions are not touched.

    One static-partition overwrite per day: a day without rows in the batch
    ends up empty (a dynamic overwrite would leave its old rows).  With ``changes`` the replaced partitions, and no
    others, are counted before.
    """
    cols = ", ".join(f"`{c}`" for c in TABLES[name].fieldNames())
    day = dt.date.fromisoformat(str(lo))
    end = dt.date.fromisoformat(str(hi if hi is not None else lo))
    while day <= end:
        rows, seen = _observed(conform(batch.where(in_days(ts, day)), name), added=F.lit(1))
        removed = 0 if changes is None else spark.table(table).where(F.col(DAY_COL) == F.lit(day)).count()
        view = _view(rows)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY_COL} = DATE'{day}') SELECT {cols} FROM {view}")
        spark.catalog.dropTempView(view)
        _note(changes, name, _sum_of(seen, "added"), removed)
        day += dt.timedelta(days=1)
    return read_days(spark, table, name)


def in_partitions(values: list[tuple], parts: list[str]) -> Column:
    """Partition filter for a list of partition values, in a form that prunes: days (or no day), and within them buckets."""
    by_rest: dict[tuple, set] = {}
    for day, *rest in values:
        by_rest.setdefault(tuple(rest), set()).add(day)
    grouped: dict[frozenset, set] = {}
    for rest, days in by_rest.items():
        grouped.setdefault(frozenset(days), set()).update(rest)
    out = F.lit(False)
    for days, buckets in grouped.items():
        known = [F.lit(d) for d in sorted(d for d in days if d is not None)]
        cond = F.col(parts[0]).isin(known) if known else F.lit(False)
        cond = cond | F.col(parts[0]).isNull() if None in days else cond
        out = out | (cond & F.col(parts[1]).isin(sorted(buckets)) if buckets else cond)
    return out


def rewrite_days(spark: SparkSession, table: str, name: str, drop: DataFrame, keys: list[str],
                 rows: DataFrame, part: str, held: DataFrame | None = None, changes: Changes | None = None) -> DataFrame:
    """Delete the rows whose ``keys`` are in ``drop`` and add ``rows``, rewriting only the partitions involved: those
    of the new rows and those that may hold a deleted key.  Rows without a day are a partition like any other.

    ``held``: the partitions (as columns named like the table's) that may hold a deleted key, where the caller knows them; the
    table is then read there only.  Without it they are found by a semi join of the key and partition columns of the whole table.

    The new rows are materialized once (a reliable checkpoint), then the new content of the partitions
    (Spark refuses to overwrite a table that the writing plan reads), which one overwrite puts in place; a
    partition left without rows is cleared after it, so a failure in between leaves a moved row twice, never lost, and
    a rerun finds and clears it.  The list of affected partitions is the only thing brought to the driver; with ``changes``,
    also the numbers of rows added and removed, which the write itself observes.
    """
    from vaultspark.session import shared_dir

    shared_dir(spark)
    current = spark.table(table)
    drop_keys = drop.select(*keys).distinct().checkpoint(eager=True)
    fresh = _with_day(rows, name, part).checkpoint(eager=True)
    parts = _parts(fresh)
    if held is None:
        held = current.select(*keys, *parts).join(drop_keys, keys, "left_semi")
    affected = [tuple(r) for r in fresh.select(*parts).union(held.select(*parts)).distinct().collect()]
    gone = F.col("_gone").isNotNull()
    lying = current.where(in_partitions(affected, parts)).join(drop_keys.withColumn("_gone", F.lit(True)), keys, "left")
    both = lying.select(*fresh.columns, gone.alias("_gone"), F.lit(False).alias("_new")).unionByName(
        fresh.withColumns({"_gone": F.lit(False), "_new": F.lit(True)}))
    both, seen = _observed(both, added=F.col("_new"), removed=F.col("_gone"))
    content = both.where(~F.col("_gone")).select(*fresh.columns).checkpoint(eager=True)
    _note(changes, name, _sum_of(seen, "added"), _sum_of(seen, "removed"))
    present = {tuple(r) for r in content.select(*parts).distinct().collect()}
    view = _view(content)
    if present:
        _overwrite_present_days(spark, table, parts, f"SELECT * FROM {view}")
    columns = ", ".join(f"`{c}`" for c in SCHEMAS[name].fieldNames())
    on_disk = {tuple(r) for r in current.select(*parts).where(in_partitions(affected, parts)).distinct().collect()} if set(affected) - present else set()
    for values in on_disk - present:
        at = ", ".join(f"{c} = {_literal(v)}" for c, v in zip(parts, values))
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({at}) SELECT {columns} FROM {view} WHERE false")
    spark.catalog.dropTempView(view)
    return read_days(spark, table, name)


def _literal(value: object) -> str:
    return "NULL" if value is None else f"DATE'{value}'" if isinstance(value, dt.date) else str(value)


def upsert_days(spark: SparkSession, table: str, name: str, batch: DataFrame, keys: list[str], order_by: str,
                part: str, moves: str | None = None, run_day: DayLike | None = None, changes: Changes | None = None) -> DataFrame:
    """Keyed upsert (newest batch row per key wins) that rewrites only the affected day partitions:
    those of the batch rows and those holding the versions the batch replaces.

    With ``moves`` (``moves_table``) the keys whose partition changes are first appended to that feed under ``run_day``, with
    their old and new day.  The feed is written before the table: a run that fails in between repeats its rows, and a rerun
    after the table was written adds none but finds those of the first attempt.
    """
    from vaultspark.operators.writes import latest_per_key
    from vaultspark.session import shared_dir

    shared_dir(spark)
    cols = SCHEMAS[name].fieldNames()
    others = [c for c in cols if c not in keys and c != order_by]
    fresh = latest_per_key(conform(batch, name), keys, [F.col(order_by).desc()] + [F.col(c).desc() for c in others])
    fresh = fresh.withColumn("_part", F.col(part)).checkpoint(eager=True)
    known = spark.table(table).select(*keys, DAY_COL)
    held = known.join(fresh.select(*keys, F.col("_part").alias("_new")), keys).checkpoint(eager=True)
    if moves is not None:
        moved = held.where(~F.col(DAY_COL).eqNullSafe(F.col("_new"))).select(
            F.col(keys[0]).alias("object_id"), F.col(DAY_COL).alias("old_day"), F.col("_new").alias("new_day"))
        append_moves(spark, moves, moved, run_day)
    return rewrite_days(spark, table, name, fresh, keys, fresh, "_part", held, changes)


def append_moves(spark: SparkSession, table: str, moved: DataFrame, run_day: DayLike | None) -> None:
    """Add ``(object_id, old_day, new_day)`` to the feed of moved orders, in the partition of the run."""
    view = _view(conform(moved, "order_moves"))
    columns = ", ".join(f"`{c}`" for c in SCHEMAS["order_moves"].fieldNames())
    day = "NULL" if run_day is None else f"DATE'{run_day}'"
    spark.sql(f"INSERT INTO {table} PARTITION ({DAY_COL} = {day}) SELECT {columns} FROM {view}")
    spark.catalog.dropTempView(view)


def append_table(spark: SparkSession, root: str, name: str, key: str | None = None, buckets: int = 0) -> str:
    """Register (idempotently) an append-only catalog table of ``name`` stored at ``root/name``.

    With ``buckets`` it is clustered by ``key``: a join or anti join on the key reads it as it lies, and shuffles the other
    side alone.  The number must stay what it was when the table was first written.
    """
    location = f"{root.rstrip('/')}/{name}"
    table = _table_name(location, name)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name].fields)
    by = f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet {by} LOCATION '{location}' "
              f"TBLPROPERTIES ('{BUCKET_COL}s' = '{buckets}', '{BUCKET_COL}_key' = '{key or ''}')")
    return table


def _bucketed(spark: SparkSession, table: str, name: str, rows: DataFrame) -> DataFrame:
    """Declared columns of ``rows``, dealt as the table's buckets are, so that a write adds one file a bucket at most."""
    rows, buckets = conform(rows, name), table_buckets(spark, table)
    if not buckets:
        return rows
    key = spark.sql(f"SHOW TBLPROPERTIES {table} ('{BUCKET_COL}_key')").first()["value"]
    return rows.repartition(buckets, key)


def load_rows(spark: SparkSession, table: str, name: str, rows: DataFrame, changes: Changes | None = None) -> DataFrame:
    """Bulk load of an append table: its whole content becomes ``rows``."""
    return _insert(spark, "OVERWRITE", table, name, rows, changes)


def _insert(spark: SparkSession, how: str, table: str, name: str, rows: DataFrame, changes: Changes | None) -> DataFrame:
    rows, seen = _observed(_bucketed(spark, table, name, rows), added=F.lit(1))
    view = _view(rows)
    spark.sql(f"INSERT {how} TABLE {table} SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    _note(changes, name, _sum_of(seen, "added"), 0)
    return read_days(spark, table, name)


def append_rows_to(spark: SparkSession, table: str, name: str, rows: DataFrame, changes: Changes | None = None) -> DataFrame:
    """``INSERT INTO``: only the new rows are written (the plan may read the table itself)."""
    return _insert(spark, "INTO", table, name, rows, changes)
