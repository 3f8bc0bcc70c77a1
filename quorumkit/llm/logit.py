"""Logistic regression on a bounded matrix of features."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Weights (the constant last) by Newton's method with a ridge penalty.

    One class only, or no rows: the constant alone, at the smoothed log odds.
    """
    n, d = x.shape
    constant = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    w = np.concatenate([np.zeros(d), [constant]])
    if n == 0 or y.min() == y.max():
        return w
    a = np.column_stack([x, np.ones(n)])
    penalty = np.concatenate([np.full(d, ridge * n), [1e-9]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (p - y) + penalty * w)
        w = w - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
