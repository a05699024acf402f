"""Linear hinge-loss models by dual coordinate descent, with sigmoid calibration."""

from __future__ import annotations

import numpy as np


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, cost: np.ndarray, epochs: int = 20, seed: int = 1) -> np.ndarray:
    """Weights (``width`` of them, then the bias) that minimise |w|^2/2 + sum(cost * hinge).

    ``rows`` hold (feature ids, values); ``y`` is -1 or 1. Each step solves the dual problem of one
    row exactly; rows go in a random order per epoch; it stops when no dual variable moves much.
    """
    w = np.zeros(width + 1)
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for _, v in rows])
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in random.permutation(len(rows)).tolist():
            ids, values = rows[i]
            gradient = y[i] * (w[ids] @ values + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[ids] += step * y[i] * values
                w[-1] += step * y[i]
                largest = max(largest, abs(step) / cost[i])
        if largest < 1e-3:
            break
    return w


def margins(rows: list[tuple[np.ndarray, np.ndarray]], w: np.ndarray) -> np.ndarray:
    return np.array([w[ids] @ values + w[-1] for ids, values in rows])


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))), by damped Newton steps on the
    log-likelihood with the targets pulled in by one row of each class."""
    positive, negative = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    theta = np.array([1.0, 0.0])

    def loss(t: np.ndarray) -> float:
        z = x @ t
        return float((np.logaddexp(0, z) - target * z).sum()) + 1e-6 * float(t @ t)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        gradient = x.T @ (p - target) + 2e-6 * theta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 2e-6 * np.eye(2)
        step, before = np.linalg.solve(hessian, gradient), loss(theta)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > before:
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
