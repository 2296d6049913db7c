"""Small logistic regression by Newton steps, for bounded training samples."""

from __future__ import annotations

import numpy as np


def _design(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(x), 1)), x], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (intercept first) over standardised features, folded back to
    the features' own scale; one class only gives its smoothed rate."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    a = _design((x - mean) / scale)
    w = np.zeros(a.shape[1])
    w[0] = np.log(rate / (1 - rate))
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    if 0 < y.sum() < len(y):
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
            gradient = a.T @ (y - p) - penalty * w
            hessian = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty)
            step = np.linalg.solve(hessian, gradient)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
    out = w.copy()
    out[1:] = w[1:] / scale
    out[0] = w[0] - (w[1:] * mean / scale).sum()
    return out


def predict_logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(x) @ w, -40, 40)))
