"""Small linear models in numpy, trained on bounded samples: a hinge-loss SVM and a logistic regression."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, epochs: int = 30, seed: int = 1) -> np.ndarray:
    """Weights (the last one for the constant) of a linear SVM with y in -1, 1: averaged stochastic subgradients in a fixed order.

    Both classes weigh the same.
    """
    rng = np.random.default_rng(seed)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum()))
    w, mean, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 32)):
            t += 1
            rate = 1 / (penalty * (t + 1 / penalty / 4))
            part = x[rows]
            wrong = y[rows] * (part @ w) < 1
            w *= 1 - rate * penalty
            if wrong.any():
                w += rate * ((y[rows] * share[rows])[wrong] @ part[wrong]) / len(rows)
            if epoch >= epochs // 2:
                mean += w
    return mean / max(1.0, np.linalg.norm(mean)) * 20 if np.linalg.norm(mean) else mean


class Sparse(NamedTuple):
    """Rows of few values: the column, row and value of each, and the numbers of rows and columns."""

    column: np.ndarray
    row: np.ndarray
    value: np.ndarray
    rows: int
    columns: int

    @classmethod
    def of(cls, columns: list[np.ndarray], values: list[np.ndarray], n: int) -> Sparse:
        none = np.zeros(0, np.int32)
        row = np.repeat(np.arange(len(columns), dtype=np.int32), [len(c) for c in columns])
        return cls(np.concatenate([none, *columns]).astype(np.int32), row, np.concatenate([none, *values]).astype(np.float32), len(columns), n)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column] * self.value, self.rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        """The transposed matrix times r."""
        return np.bincount(self.column, r[self.row] * self.value, self.columns)


def logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, swaps: Sparse, pull: float, penalty: float = 5e-4, steps: int = 300, rate: float = 0.1) -> np.ndarray:
    """Weights (the last one for the constant) of a logistic regression with y in 0, 1.

    swaps: rows of feature changes that must not matter; the mean square of the score change that they cause is
    added to the loss, times `pull`.
    """
    weight = weight / weight.sum()
    w = np.zeros(x.columns + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w[:-1]) + w[-1], -30, 30)))
        r = (weight * (p - y)).astype(np.float32)
        g = np.r_[x.back(r) + penalty * w[:-1], r.sum()].astype(np.float32)
        if swaps.rows:
            g[:-1] += (2 * pull * swaps.back(swaps.dot(w[:-1]).astype(np.float32)) / swaps.rows).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w
