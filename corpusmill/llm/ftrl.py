"""Follow-the-regularised-leader with elastic-net penalties, for sparse rows and any number of classes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Ftrl:
    """Weights of `classes` linear scores over `width` features; one class means a logistic score, more a softmax."""

    def __init__(self, classes: int, width: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((width, classes)), np.zeros((width, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, at: np.ndarray, gradient: np.ndarray, w: np.ndarray) -> None:
        """One leader step for the features `at` (each once); gradient has their rows."""
        n = self.n[at]
        grown = n + gradient**2
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def bounded(sample: DataFrame, order: list[str], size: Column, rows: int, features: int) -> DataFrame:
    """The first rows of a sample that is bounded in rows, in order, as long as their features are no more than that in all: what the driver takes is bounded in bytes too, however long the texts are."""
    first = sample.withColumn("_size", size).orderBy(*order, "_size").limit(rows)
    return first.withColumn("_seen", F.sum("_size").over(Window.orderBy(*order, "_size"))).filter(F.col("_seen") <= features).drop("_size", "_seen")
