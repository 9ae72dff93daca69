"""Quality classifier: naive Bayes support vectors over word n-grams."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspark.llm import linear

BITS = 20
PER_CLASS = 5000  # bound of the labelled sample the model is fitted on, per class
TOKEN = re.compile(r"\w+|[^\w\s]+")


def word_ngrams(text: str) -> np.ndarray:
    """Distinct hashed words (runs of word characters, runs of other visible characters) and pairs of neighbours."""
    words = np.array([crc32(t.encode("utf-8", "surrogatepass")) for t in TOKEN.findall(text)], dtype=np.uint32)
    mixed = words * np.uint32(2654435761)
    pairs = (mixed[:-1] ^ (words[1:] + np.uint32(0x9E3779B9))) * np.uint32(2246822519)
    return np.unique(np.concatenate([mixed, pairs]) >> np.uint32(32 - BITS))


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> linear.LinearModel:
    """Hinge-loss model of the indicators scaled by log-count ratios, by dual coordinate descent."""
    return linear.train(docs, labels, "quality", word_ngrams, 1 << BITS, linear.dual_coordinate_descent, per_class)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = 0.3,
                  carry: tuple[str, ...] = ("doc_id",), per_class: int = PER_CLASS) -> DataFrame:
    """``carry``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Labels of the held-out fold (crc32 of the id modulo ``folds`` equal to ``held_fold``) are never used.  Null and empty texts get the
    score of a text without features; repeated rows score alike; without usable labels every score is 0.5.
    """
    training = labels.where(linear.fold("doc_id", folds) != held_fold)
    model = train_quality(docs, training, per_class)
    scored = linear.score(docs, model, word_ngrams, list(carry))
    return (scored.withColumn("held_out", linear.fold("doc_id", folds) == held_fold)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
