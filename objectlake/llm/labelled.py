"""Bounded labelled samples, and logistic models fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick


def remainder(key: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null ids have none."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def held_out(key: Column, folds: int, fold: int) -> Column:
    return F.coalesce(remainder(key, folds) == fold, F.lit(False))


def learnable(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) of the rows that may be learnt from;
    an id with several labels has the largest."""
    rows = pick(labels, "doc_id", label).withColumnRenamed(label, "label")
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), folds, fold))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def some(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, by a hash of the id."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the last one the constant) by Newton's method; ``ridge`` holds
    back all but the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    hold = np.full(len(w), ridge)
    hold[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + hold * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
