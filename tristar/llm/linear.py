"""Logistic regression on hashed features, with Platt calibration.

Fitted on the driver from a bounded sample of labelled rows (the callers' documented
``sample`` parameter); the fitted model is a dense weight vector of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows of (column, value) pairs; ``off`` holds each row's first pair."""
    off: np.ndarray
    col: np.ndarray
    val: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        size = [len(c) for c, _ in rows]
        cat = (lambda i, t: np.concatenate([r[i] for r in rows]).astype(t) if rows else np.zeros(0, t))
        return cls(np.concatenate([[0], np.cumsum(size)]).astype(np.int64),
                   cat(0, np.int64), cat(1, np.float64))

    def dot(self, w: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0.0], np.cumsum(w[self.col] * self.val)])
        return c[self.off[1:]] - c[self.off[:-1]]

    def t_dot(self, r: np.ndarray, dims: int) -> np.ndarray:
        return np.bincount(self.col, self.val * np.repeat(r, np.diff(self.off)), dims)


@dataclass
class Dense:
    """Rows of a matrix of bounded size."""
    rows: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        return (self.rows @ w.astype(self.rows.dtype)).astype(np.float64)

    def t_dot(self, r: np.ndarray, dims: int) -> np.ndarray:
        return (r.astype(self.rows.dtype) @ self.rows).astype(np.float64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Sparse | Dense, y: np.ndarray, weight: np.ndarray, dims: int, steps: int = 80,
        rate: float = 0.3, l2: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by full-batch Adam: (weights, intercept)."""
    weight = weight / weight.sum()
    w = np.zeros(dims + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        r = (sigmoid(x.dot(w[:-1]) + w[-1]) - y) * weight
        g = np.append(x.t_dot(r, dims) + l2 * w[:-1], r.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn scores into probabilities: Newton steps on the
    weighted log loss with Platt's smoothed targets. (1, 0) if one class is missing."""
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    if pos <= 0 or neg <= 0:
        return 1.0, 0.0
    scale = len(y) / weight.sum()
    target = np.where(y == 1, 1 - 1 / (pos * scale + 2), 1 / (neg * scale + 2))
    spread = max(float(z.std()), 1e-9)  # unit scale keeps Newton's steps small
    u, a, b = z / spread, 1.0, 0.0
    for _ in range(100):
        p = sigmoid(a * u + b)
        r, h = (p - target) * weight, np.maximum(p * (1 - p), 1e-4) * weight
        grad = np.array([(r * u).sum(), r.sum()])
        hess = np.array([[(h * u * u).sum(), (h * u).sum()], [(h * u).sum(), h.sum()]])
        step = np.clip(np.linalg.solve(hess + 1e-6 * weight.sum() * np.eye(2), grad), -0.5, 0.5)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(max(a, 1e-3) / spread), float(b)
