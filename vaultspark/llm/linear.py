"""Linear text classifiers over hashed features scaled by naive Bayes log-count ratios.

A model is fitted on a bounded, documented sample of labelled rows (of either class at most ``per_class`` rows and ``max_ids``
feature ids, the smallest hashes of doc_id first); every document is scored.  Only that sample's feature ids reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import shuffle_partitions, written

MAX_IDS = 6_000_000  # bound of the feature ids of a class that a model is fitted on
ROWS = 500  # of a batch, turned into Python strings at a time

Features = Callable[[str], np.ndarray]  # a text's distinct feature ids, ascending


@dataclass(frozen=True)
class LinearModel:
    """P(label 1) = sigmoid(slope * (sum of a text's weights + bias) + shift)."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r].sum(dtype=np.float64) + self.bias for r in rows], dtype=np.float64)


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, buckets: int, alpha: float = 1.0) -> np.ndarray:
    """Naive Bayes log-count ratio of every feature: log(p / |p|) - log(q / |q|), counts smoothed by ``alpha``."""
    def share(keep: np.ndarray) -> np.ndarray:
        counts = np.full(buckets, alpha)
        for r, k in zip(rows, keep):
            if k:
                counts[r] += 1
        return counts / counts.sum()

    return np.log(share(y == 1) / share(y == 0))


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = 1.0,
                            epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights of the raw indicators and the bias of a linear hinge-loss model of the scaled ones: one dual variable
    in [0, cost] per row, updated in a new random order each epoch; a constant feature is the bias.

    The weight of a scaled indicator times its scale is kept, so that no scaled copy of the rows is needed.
    """
    sign, squared = np.where(y == 1, 1.0, -1.0), scale * scale
    diagonal = np.array([squared[r].sum() + 1.0 for r in rows])
    w, bias, dual, order = np.zeros(len(scale)), 0.0, np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]].sum() + bias) - 1
            new = min(max(dual[i] - gradient / diagonal[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                w[rows[i]] += step * squared[rows[i]]
                bias += step
                moved = max(moved, abs(new - dual[i]) * diagonal[i])
                dual[i] = new
        if moved < 1e-3:
            break
    return w, bias


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a sigmoid fitted to held-back margins (Platt's smoothed targets, Newton steps)."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    unit = max(float(np.std(margin)), 1e-9)
    x = np.stack([margin / unit, np.ones(len(margin))], axis=1)
    theta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * theta)
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0] / unit), float(theta[1])


def fit(rows: list[np.ndarray], y: np.ndarray, buckets: int, solver: Callable, odds: float | None = None) -> LinearModel:
    """Ratios and weights from all rows; the sigmoid from the margins that models of three quarters give the last
    quarter, in turn.  ``odds`` (label 1 to label 0 among all training labels) undoes the sample's balance.  With
    no rows, or one class, the score is constant."""
    y = np.asarray(y)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return LinearModel(np.zeros(buckets, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))

    def model(keep: np.ndarray) -> LinearModel:
        use = [r for r, k in zip(rows, keep) if k]
        weights, bias = solver(use, y[keep], log_count_ratios(use, y[keep], buckets))
        return LinearModel(weights.astype(np.float32), bias, 1.0, 0.0)

    turn = np.zeros(len(y), int)
    for label in (0, 1):
        turn[y == label] = np.arange((y == label).sum()) % 4
    margin, seen = np.zeros(len(y)), np.zeros(len(y), bool)
    for k in range(4):
        if (turn == k).any() and len(set(y[turn != k].tolist())) == 2:
            margin[turn == k] = model(turn != k).margins([r for r, t in zip(rows, turn) if t == k])
            seen |= turn == k
    whole = model(np.ones(len(y), bool))
    if len(set(y[seen].tolist())) < 2:  # a class with a single row
        margin, seen = whole.margins(rows), np.ones(len(y), bool)
    slope, shift = platt(margin[seen], y[seen])
    if odds:
        shift += float(np.log(odds) - np.log((y[seen] == 1).sum() / (y[seen] == 0).sum()))
    return LinearModel(whole.weights, whole.bias, slope, shift)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id has the checksum of the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, label: str, features: Features, buckets: int, solver: Callable,
          per_class: int, max_ids: int = MAX_IDS) -> LinearModel:
    """Fit on a bounded sample of labelled rows: of either class the first ``per_class`` in the order of their doc_id's
    hash, as far as they have ``max_ids`` feature ids together (so that the driver gets 8 * ``max_ids`` bytes at most).

    ``labels(doc_id, <label>)`` holds the training rows only; other labels than 0 and 1 and rows without a
    document are left out.  A doc_id counts once, with its largest label and smallest text."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("_labelled")).agg(F.max(F.col(label).cast("int")).alias("_y"))
    counts = dict(known.groupBy("_y").count().collect())
    sample = None
    for value in (0, 1):
        part = known.where(F.col("_y") == value).orderBy(F.xxhash64("_labelled"), "_labelled").limit(per_class)
        sample = part if sample is None else sample.union(part)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ids = [features(t or "").astype("<u4").tobytes() for t in pdf["text"]]
            yield pd.DataFrame({"y": pdf["_y"], "nr": pdf["nr"], "ids": ids})

    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled"))
             .groupBy("_labelled", "_y").agg(F.min("text").alias("text"))  # repeated rows of a document are one
             .repartition(shuffle_partitions(docs.sparkSession), "_labelled")  # small task results
             .select("_y", F.xxhash64("_labelled").alias("nr"), "text"))
    found = written(texts.mapInPandas(scan, "y int, nr long, ids binary"), "training-features")
    running = Window.partitionBy("y").orderBy("nr", F.octet_length("ids"), "ids")  # at most ``per_class`` rows each
    kept = found.withColumn("total", F.sum(F.octet_length("ids").cast("long")).over(running)).where(F.col("total") <= 4 * max_ids)
    rows = kept.select("y", "ids").collect()
    rows.sort(key=lambda r: (r["y"], len(r["ids"]), crc32(r["ids"])))  # the model does not depend on the order of arrival
    ids = [np.frombuffer(r["ids"], "<u4") for r in rows]
    odds = counts.get(1, 0) / counts[0] if counts.get(0) else None
    return fit(ids, np.array([r["y"] for r in rows]), buckets, solver, odds)


def score(docs: DataFrame, model: LinearModel, features: Features, carry: list[str], name: str = "score") -> DataFrame:
    """The columns ``carry`` of every row of ``docs`` and, as ``name``, the probability of label 1 (null text: empty).

    The text passes to Python once, also where it is carried; a carried column named ``name`` is left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight a bucket
    kept = [c for c in carry if c != name]
    columns = kept if "text" in kept else [*kept, "text"]
    at_text, types = columns.index("text"), {f.name: f.dataType for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {types[c].simpleString()}" for c in kept] + [f"`{name}` double"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                margins = [m.weights[features(t or "")].sum(dtype=np.float64) + m.bias for t in part.column(at_text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(m.probability(np.array(margins, dtype=np.float64)))], names=[*kept, name])

    return docs.select(*columns).mapInArrow(scan, schema)
