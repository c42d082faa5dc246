"""Labelled rows for training, and small calibrations that both classifiers use."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold_of(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; a null id is in fold 0 (held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS, F.lit(0))


def _marked(labels: DataFrame, target: str, id_col: str) -> DataFrame:
    """(doc_id, label) of the labelled documents outside fold 0; one labelled twice counts once, with the larger label."""
    marked = labels.where(F.col(target).isin(0, 1) & (fold_of(id_col) != 0))
    return marked.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(target).cast("int").alias("label"))


def class_weights(labels: DataFrame, target: str, rows: int, id_col: str = "doc_id") -> dict[int, float]:
    """How many labelled rows of its class a row of ``training_rows`` stands for; 1 where none were left out."""
    counts = _marked(labels, target, id_col).groupBy("label").count().collect()
    return {r["label"]: max(1.0, r["count"] / rows) for r in counts}


def training_rows(docs: DataFrame, labels: DataFrame, target: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``rows`` labelled documents of each class outside fold 0: (doc_id, text, label), one row an id.

    Of documents that share an id the text with the least hash is taken, so repeated ids do not pass the bound.

    The bound is on labelled rows only; which are taken follows a hash of the id,
    so it does not depend on their order.  The bound thins the larger class, so what
    is fitted on these rows has to weigh them by ``class_weights``.
    """
    marked = _marked(labels, target, id_col).withColumn("draw", F.xxhash64("doc_id"))
    parts = [marked.where(F.col("label") == k).orderBy("draw", "doc_id").limit(rows) for k in (0, 1)]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chosen = parts[0].unionByName(parts[1]).select("doc_id", "label")
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most 2 * rows ids
    return found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")))["text"].alias("text")).select("doc_id", "text", "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, intercept of a ridge logistic regression by Newton steps.

    ``y`` may hold probabilities.  ``weight`` says how much each row counts, relative
    to the others.  The intercept is not penalised.
    """
    weight = np.ones(len(x)) if weight is None else weight / weight.mean()
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * max(len(x), 1))
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        move = np.linalg.solve(curvature, gradient)
        w -= move / max(1.0, np.abs(move).max() / 4)
        if np.abs(move).max() < 1e-8:
            break
    return w
