"""Toxicity classifier: character n-grams scaled by naive Bayes log-count ratios, hinge loss."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspark.llm import linear

BITS = 20
SIZES = (3, 4, 5, 6)
PER_CLASS = 2500  # bound of the labelled sample the model is fitted on, per class
BLOCK = 1 << 20  # characters of a text hashed at a time


def char_ngrams(text: str) -> np.ndarray:
    """Distinct hashed n-grams of 3 to 6 characters (code points) of the lower-cased text between two blanks."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    found = []
    for at in range(0, max(1, len(data) - 2), BLOCK):
        block = data[at:at + BLOCK + max(SIZES) - 1]
        grams, h = [], np.zeros(len(block), np.uint32)
        for n in range(1, max(SIZES) + 1):
            if n > len(block):
                break
            h = h[:len(block) - n + 1] * np.uint32(16777619) + block[n - 1:] + np.uint32(n)
            if n in SIZES:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
                grams.append(mixed >> np.uint32(32 - BITS))
        found.append(np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint32))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> linear.LinearModel:
    """Hinge-loss model of the character n-grams scaled by log-count ratios, by dual coordinate descent."""
    return linear.train(docs, labels, "toxic", char_ngrams, 1 << BITS, linear.dual_coordinate_descent, per_class)


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, threshold: float = 0.7,
                   carry: tuple[str, ...] = ("doc_id",), per_class: int = PER_CLASS) -> DataFrame:
    """``carry``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``; cases as in ``score_quality``."""
    training = labels.where(linear.fold("doc_id", folds) != held_fold)
    model = train_toxicity(docs, training, per_class)
    scored = linear.score(docs, model, char_ngrams, list(carry))
    return (scored.withColumn("held_out", linear.fold("doc_id", folds) == held_fold)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
