"""Exact top-k inner products by pivot-table elimination.

Every vector's distances to a set of pivots are computed once.  For a query q and a candidate x the largest
difference of their distances to a pivot bounds |q - x| from below, hence their inner product
(|q|^2 + |x|^2 - |q - x|^2) / 2 from above.  Candidates are evaluated in the order of that bound until it can't
reach the k-th best score.  Queries and candidates meet in tiles of fixed size: all query blocks against all candidate blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import shuffle_partitions, written

PIVOTS = 32
PIVOT_SAMPLE = 1024  # vectors (the smallest hashes of their ids) among which pivots are chosen; results don't depend on it
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * component), as double: a double holds the floor of a double exactly, whatever its size."""
    return F.transform(vector, lambda x: _floor(F.lit(float(scale)) * x.cast("double")))


def _floor(y: Column) -> Column:
    return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)  # beyond, every double is whole


def usable(vector: Column) -> Column:
    """Not null and without null, NaN or infinite components."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Farthest-first pivots, from the vector of largest norm on."""
    if not len(sample):
        return sample
    chosen = [int((sample ** 2).sum(1).argmax())]
    far = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None, :] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def exact_products(q: np.ndarray, c: np.ndarray, q2: float, c2: float) -> tuple[np.ndarray, np.ndarray]:
    """``q`` and ``c`` in a type in which every sum of products of their components is exact; ``q2`` and ``c2`` are their
    largest squared norms, whose product bounds those sums.  Scores beyond 64 bits are an error, never a wrong number."""
    bound = q2 * c2
    if bound < 2.0 ** 48:
        return q.astype(np.float32), c.astype(np.float32)
    if bound < 2.0 ** 105:
        return q, c
    if bound >= 2.0 ** 125 or max(np.abs(q).max(), np.abs(c).max()) >= 2.0 ** 62:
        raise OverflowError("inner products of these vectors may pass 64 bits")
    return q.astype(np.int64), c.astype(np.int64)


def search_tile(qnr: np.ndarray, q: np.ndarray, qd: np.ndarray, cnr: np.ndarray, cid: np.ndarray, c: np.ndarray, cd: np.ndarray,
                k: int, chunk: int = 256) -> tuple[list, list, list, int]:
    """Top k of a tile per query row: (query row numbers, candidate ids, scores) and the number of products evaluated."""
    out_q, out_c, out_s, evaluated = [], [], [], 0
    q2, c2 = (q ** 2).sum(1), (c ** 2).sum(1)
    rounding = (q.shape[1] + 8) * np.finfo(float).eps  # of the squared norms; nothing for whole numbers below 2 ** 53
    q, c = exact_products(q, c, q2.max(initial=0), c2.max(initial=0))
    qd, cd = qd.astype(np.float32), np.ascontiguousarray(cd.astype(np.float32).T)
    longest = np.sqrt(max(q2.max(initial=0), c2.max(initial=0)))
    slack = 1e-6 * (1 + max(qd.max(initial=0), cd.max(initial=0)) + longest)  # of single precision, and of distances from rounded squares
    for at in range(0, len(qnr), 32):
        rows = slice(at, at + 32)
        gap = np.zeros((len(qnr[rows]), len(cid)), np.float32)
        step = np.empty_like(gap)
        for j in range(qd.shape[1]):
            np.subtract(qd[rows, j, None], cd[j], out=step)
            np.abs(step, out=step)
            np.maximum(gap, step, out=gap)
        both = q2[rows, None] + c2[None, :]
        bounds = (both - np.maximum(gap.astype(np.float64) - slack, 0) ** 2) / 2 + 1e-6 + rounding * both
        for i, bound in enumerate(bounds, at):
            bound[cnr == qnr[i]] = -np.inf  # never the query's own row
            first = np.argpartition(-bound, chunk)[:chunk] if len(bound) > chunk else np.arange(len(bound))
            first = first[bound[first] > -np.inf]
            best_id, best = cid[first], c[first] @ q[i]
            evaluated += len(first)
            rank = np.lexsort((best_id, -best))[:k]
            best_id, best = best_id[rank], best[rank]
            bound[first] = -np.inf
            rest = np.flatnonzero(bound >= (best[-1] if len(best) == k else -np.finfo(float).max))
            rest = rest[np.argsort(-bound[rest])]
            for s in range(0, len(rest), 8 * chunk):
                part = rest[s:s + 8 * chunk]
                if len(best) == k and bound[part].max() < best[-1]:
                    break
                evaluated += len(part)
                score = c[part] @ q[i]
                if len(best) == k:
                    part, score = part[score >= best[-1]], score[score >= best[-1]]
                best_id, best = np.concatenate([best_id, cid[part]]), np.concatenate([best, score])
                rank = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[rank], best[rank]
            out_q.append(np.full(len(best), qnr[i]))
            out_c.append(best_id)
            out_s.append(best.astype(np.int64))
    return out_q, out_c, out_s, evaluated


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, pivots: int = PIVOTS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k largest inner products of every query (vec_id divisible by
    ``every``) with all other rows, ties to the smaller vec_id.

    Vectors that are null or hold null or non-finite components and rows with a null vec_id take no part.  Shorter
    vectors count as padded with zeros.  Rows are told apart by their place in the table, not by vec_id: every row with
    a query id is a query of its own, with all other rows as candidates, those of its own id included.  Scores are exact
    up to 62 bits; vectors whose products may pass that are an error.
    """
    spark = vectors.sparkSession
    base = written(vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), quantised(F.col("embedding"), scale).alias("v")), "vectors")
    rows, width = base.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, width or 1)
    sample = [r["v"] for r in base.orderBy(F.xxhash64("vec_id"), "v").limit(PIVOT_SAMPLE).select("v").collect()]
    centres = choose_pivots(_matrix(pd.Series(sample, dtype=object), width), pivots)

    def measure(frames):
        for pdf in frames:
            yield pdf.assign(d=list(pivot_distances(_matrix(pdf["v"], width), centres)) if len(pdf) else [])

    table = base.mapInPandas(measure, "vec_id long, v array<double>, d array<double>")
    table = written(table.withColumn("nr", F.monotonically_increasing_id()), "pivot-table")  # nr tells repeated rows apart
    queries = table.where(F.col("vec_id") % every == 0).select("vec_id", "v", "d", "nr")
    c_blocks = max(1, math.ceil(rows / CANDIDATE_BLOCK))
    q_blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))

    def dealt(df: DataFrame, own: int, other: int, query: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("nr"), F.lit(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        df = df.withColumn("block", block).withColumn("each", each)
        tile = F.struct(F.col("block" if query else "each").alias("q"), F.col("each" if query else "block").alias("c"))
        return df.select(tile.alias("tile"), F.lit(query).alias("query"), "nr", "vec_id", "v", "d")

    tiles = dealt(queries, q_blocks, c_blocks, True).union(dealt(table, c_blocks, q_blocks, False))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf[pdf["query"]]
        gives = pdf[~pdf["query"]]
        if not len(asks) or not len(gives):
            return pd.DataFrame({"nr": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        at, ids, scores, _ = search_tile(
            asks["nr"].to_numpy(), _matrix(asks["v"], width), np.stack(asks["d"].to_list()), gives["nr"].to_numpy(),
            gives["vec_id"].to_numpy(), _matrix(gives["v"], width), np.stack(gives["d"].to_list()), k)
        nr = np.concatenate(at)
        return pd.DataFrame({"nr": nr, "query_id": asks.set_index("nr")["vec_id"].reindex(nr).to_numpy(),
                             "vec_id": np.concatenate(ids), "score": np.concatenate(scores)})

    found = tiles.repartition(shuffle_partitions(spark), "tile").groupBy("tile").applyInPandas(
        search, "nr long, query_id long, vec_id long, score long")
    order = Window.partitionBy("nr").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
