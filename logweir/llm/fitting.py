"""What the numpy networks share: Adam, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels that one classifier may have. A column with more is not a label.
LABELS_AT_MOST = 500


class Adam:
    """Adam with a linearly falling step over named arrays, changed in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, steps: int) -> None:
        self.weights, self.rate, self.steps, self.t = weights, rate, steps, 0
        self.mean = {k: np.zeros_like(w) for k, w in weights.items()}
        self.square = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        rate = self.rate * (1 - self.t / self.steps)
        self.t += 1
        for k, g in grads.items():
            g = g * scale
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            m, v = self.mean[k] / (1 - 0.9 ** self.t), self.square[k] / (1 - 0.99 ** self.t)
            self.weights[k] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(self.weights[k].dtype)


def label_counts(rows: DataFrame, label: str) -> dict:
    """How many rows each non-null label has."""
    found = rows.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).limit(
        LABELS_AT_MOST + 1).collect()
    if len(found) > LABELS_AT_MOST:
        raise ValueError(f"{label} has more than {LABELS_AT_MOST} values")
    return {r[0]: r[1] for r in sorted(found)}


def per_label_sample(rows: DataFrame, label: str, key: Column, counts: dict, each: int) -> DataFrame:
    """About ``each`` rows of each label and never more than twice as many in all: those with the
    smallest hash of ``key``, which doesn't depend on how the rows are stored."""
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 40)).alias("draw")
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == value, min(1.0, each / n)).otherwise(share)
    picked = rows.withColumn("draw", draw).filter(F.col("draw") < share * (1 << 40))
    return picked.orderBy("draw").limit(2 * each * max(1, len(counts)))
