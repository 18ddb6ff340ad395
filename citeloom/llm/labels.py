"""What the two trained document classifiers share: which labels may be learned from, and a bounded sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(FOLDS))


def label_sample(labels: DataFrame, label: str, bounds: dict[int, int], id_col: str = "doc_id") -> DataFrame:
    """At most ``bounds[y]`` ids of each label y from the folds that may be learned from, lowest hash first.

    Rows without id or label are not learned from; of ids with several labels the largest counts.
    """
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (fold(id_col) != 0))
    rows = rows.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_y"))
    parts = [rows.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n) for y, n in sorted(bounds.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 100, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Scale and shift of a logistic map from margins to probabilities, by Newton's method with smoothed targets.

    With one class only, margins are taken as they are. ``weight`` says how often each margin occurs.
    """
    n = np.ones(len(y)) if weight is None else weight
    pos, neg = float(n[y == 1].sum()), float(n[y == 0].sum())
    if not pos or not neg:
        return 1.0, 0.0
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n * (np.logaddexp(0, z) - t * z)).sum()) + 5e-4 * float(w @ w)

    w = np.array([0.0, np.log((pos + 1) / (neg + 1))])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        g = x.T @ (n * (p - t)) + 1e-3 * w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), g)
        size, before = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    if w[0] < 1e-3:  # the margins do not tell the classes apart
        return 1e-3, float(np.log((pos + 1) / (neg + 1)) - 1e-3 * np.average(margin, weights=weight))
    return float(w[0]), float(w[1])
