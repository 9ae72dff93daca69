"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.session import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, reread.

    Cuts the lineage and fixes the rows: a lost executor costs a reread, not a recomputation.
    """
    path = shared_dir(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, or with underscores after it where ``columns`` has it already (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def join_per_key(rows: DataFrame, table: DataFrame, keys: list[str], held: str) -> DataFrame:
    """Left join of a written table with one that has one row a key and, as ``held``, how many of ``rows`` hold it.

    Keys of more rows than a quarter of a shuffle partition would take a task of their own: there are at most four a partition,
    so these are broadcast and their rows stay where they are; the others are shuffled.  Keys aren't null.
    """
    least = rows.count() // (4 * shuffle_partitions(rows.sparkSession)) + 1  # the count comes from the files' footers
    values = [c for c in table.columns if c not in (*keys, held)]
    hot = table.where(F.col(held) > least).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.struct(*values).alias("_hot"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot_{k}") for k in keys])
    marked = rows.join(F.broadcast(hot), same, "left")
    near = marked.where(F.col("_hot").isNotNull()).select(*rows.columns, "_hot.*")
    rest = marked.where(F.col("_hot").isNull()).select(*rows.columns).join(table.drop(held), keys, "left")
    return near.unionByName(rest)


def map_columns(df: DataFrame, schema: pa.Schema, ddl: str, make: Callable[[], Callable]) -> DataFrame:
    """``mapInArrow`` over lists: ``make()`` runs once a task and returns a function from a batch's columns (Python
    lists, nulls as None) to the output's columns.  Integers stay exact beside nulls."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                out = work(*[c.to_pylist() for c in batch.slice(at, BATCH_ROWS).columns])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    return df.mapInArrow(scan, ddl)


BATCH_ROWS = 500
