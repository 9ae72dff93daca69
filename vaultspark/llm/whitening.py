"""Whitening of embeddings by a covariance from variances alone (polarisation)."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspark.llm.common import written

SCALE = 256
COMPONENTS = 4
BATCH = 256  # rows whose squares are added up as machine integers
LIMB = 27


def usable(vector: Column) -> Column:
    """Not null and without null, NaN or infinite entries."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) as long; an entry beyond the range of a long is an error, never a wrong number."""
    def whole(c: Column) -> Column:
        y = F.lit(float(scale)) * c.cast("double")
        wrong = F.raise_error(F.lit("an embedding entry is too large for a 64-bit integer")).cast("long")
        return F.when(F.abs(y) < float(1 << 63), F.floor(y)).otherwise(wrong)

    return F.transform(vector, whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """List entries as rows, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    ends = np.asarray(column.offsets)
    flat, sizes = np.asarray(column.flatten(), dtype=np.int64), np.diff(ends)
    if len(flat):
        row = np.repeat(np.arange(len(column)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part, _matrix(part.column(part.num_columns - 1), width)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: machine integers where they can't overflow, else Python's."""
    if x.size and n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def sums_of_squares(p: np.ndarray) -> list[int]:
    """Exact sum of squares of every column of at most ``BATCH`` rows: squares of 27-bit halves while they fit."""
    if p.dtype != object and p.size and max(int(p.max()), -int(p.min())) < 1 << (2 * LIMB - 1):
        high, low = p >> LIMB, p & ((1 << LIMB) - 1)
        halves = ((high * high).sum(0), (high * low).sum(0), (low * low).sum(0))  # each below 2 ** 62
        return [(int(a) << 2 * LIMB) + (int(b) << LIMB + 1) + int(c) for a, b, c in zip(*halves)]
    return [int(v) for v in (p.astype(object) ** 2).sum(0)] if len(p) else [0] * p.shape[1]


def _exact_sums(df: DataFrame, work) -> dict[int, int]:
    """``work(batches)`` gives, per task, {slot: exact sum}; the sums of all tasks by slot.

    Sums travel as (low 60 bits, rest) decimals, so that Spark adds them exactly.  One row a slot reaches the driver.
    """
    schema = pa.schema([("slot", pa.int64()), ("low", pa.decimal128(38)), ("high", pa.decimal128(38))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(batches)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(found), pa.int64()), pa.array([Decimal(v & ((1 << 60) - 1)) for v in found.values()], pa.decimal128(38)),
            pa.array([Decimal(v >> 60) for v in found.values()], pa.decimal128(38))], schema=schema)

    rows = df.mapInArrow(scan, "slot long, low decimal(38,0), high decimal(38,0)").groupBy("slot").agg(
        F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    return {r["slot"]: int(r["low"]) + (int(r["high"]) << 60) for r in rows}


def dimension_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension."""
    def work(batches: Iterator[pa.RecordBatch]) -> dict[int, int]:
        n, total = 0, [0] * width
        for part, x in _batches(batches, width):
            n += len(x)
            small = max(int(x.max()), -int(x.min())) < 1 << 50 if x.size else True
            total = [a + int(b) for a, b in zip(total, (x if small else x.astype(object)).sum(0))]
        return {-1: n, **dict(enumerate(total))}

    found = _exact_sums(fit, work)
    return found.get(-1, 0), [found.get(d, 0) for d in range(width)]


def squares(fit: DataFrame, width: int, n: int, sums: list[int]) -> dict[int, int]:
    """Exact sums of squares of n * x - sums for every dimension d (slot d * width + d) and every sum of two
    dimensions d < e (slot d * width + e)."""
    def work(batches: Iterator[pa.RecordBatch]) -> dict[int, int]:
        total = {}
        for _, x in _batches(batches, width):
            z = centred(x, n, sums)
            for d in range(width):
                pair = z[:, d:] + z[:, d:d + 1]
                pair[:, 0] = z[:, d]
                for e, v in enumerate(sums_of_squares(pair), d):
                    total[d * width + e] = total.get(d * width + e, 0) + v
        return total

    return _exact_sums(fit, work)


def covariance(found: dict[int, int], width: int, n: int) -> np.ndarray:
    """Half of Var(d + e) - Var(d) - Var(e), from exact sums; each entry is rounded once."""
    v = np.zeros((width, width))
    for d in range(width):
        v[d, d] = found[d * width + d] / n ** 3
        for e in range(d + 1, width):
            cross = found[d * width + e] - found[d * width + d] - found[e * width + e]
            v[d, e] = v[e, d] = cross / (2 * n ** 3)
    return v


def axes(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(projection to whitened components, explained shares, eigenvalues), largest eigenvalue first, those that are zero to
    double precision left out.  The largest entry of an axis is positive."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    kept = int((e[:components] > len(v) * np.finfo(float).eps * max(e.max(initial=0.0), 0.0)).sum())
    e, u = e[:kept], u[:, :kept]
    u = u * np.sign(u[np.abs(u).argmax(0), np.arange(kept)])
    return u / np.sqrt(e), e / np.trace(v) if kept else e, e


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, carry: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``carry, component, n, deviation, whitened, explained, identity_error`` for every usable row and component.

    Entries become x = floor(scale * entry).  The covariance is over the distinct x vectors (``n`` of them, divisor n): every
    dimension and every sum of two dimensions gives one variance from exact sums of squares of n * x - sums, and
    differences of variances give the cross-covariances.  ``deviation`` (decimal) is the row's exact sum of squares of
    n * x - sums; ``identity_error`` the largest distance of the covariance of the whitened fit list, added up over all of it,
    from the identity.

    Rows whose vector is null or holds null or non-finite entries are left out; repeated rows are kept, and count once in the
    fit.  Shorter vectors count as padded with zeros.  Components without variance are left out, so a single distinct
    vector, empty vectors and an empty table give no rows.  An entry too large for a 64-bit integer is an error.  Carried columns
    named like a result are left out.  The driver gets the D (D + 1) / 2 sums of D dimensions, which eigh needs.
    """
    own = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    kept = [c for c in carry if c not in own]
    spark, types = vectors.sparkSession, {f.name: f.dataType for f in vectors.schema.fields}
    result = ", ".join([f"`{c}` {types[c].simpleString()}" for c in kept] + [
        "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"])
    rows = vectors.where(usable(F.col("embedding"))).select(*kept, quantised(F.col("embedding"), scale).alias("_x"))
    width = rows.agg(F.max(F.size("_x"))).first()[0] or 0
    padded = F.concat("_x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("_x")))
    fit = written(rows.select(padded.alias("_x")).distinct(), "whitening-fit")
    n, sums = dimension_sums(fit, width) if width else (0, [])
    if n < 2:
        return spark.createDataFrame([], result)
    v = covariance(squares(fit, width, n, sums), width, n)
    projection, explained, _ = axes(v, components)
    count = projection.shape[1]
    if not count:
        return spark.createDataFrame([], result)
    shared = spark.sparkContext.broadcast(projection)  # ``components`` numbers a dimension

    def project(z: np.ndarray) -> np.ndarray:
        return (z.astype(np.float64) / n) @ shared.value

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, line = np.zeros((count, count)), np.zeros(count)
        for _, x in _batches(batches, width):
            y = project(centred(x, n, sums))
            total, line = total + y.T @ y, line + y.sum(0)
        slots = np.concatenate([total.ravel(), line])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(slots))), pa.array(slots)], names=["slot", "value"])

    got = fit.mapInArrow(products, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(count * count + count)
    for r in got:
        values[r["slot"]] = r["value"]
    mean = values[count * count:] / n
    error = float(np.abs(values[:count * count].reshape(count, count) / n - np.outer(mean, mean) - np.eye(count)).max())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _batches(batches, width):
            z = centred(x, n, sums)
            each = np.repeat(np.arange(len(x)), count)
            deviation = [Decimal(d) for d in (z.astype(object) ** 2).sum(1)]
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(each)) for c in part.columns[:-1]],
                 pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n, np.int64)),
                 pa.array(deviation, pa.decimal128(38)).take(pa.array(each)), pa.array(project(z).ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))],
                names=[*kept, *own])

    return rows.mapInArrow(spread, result)
