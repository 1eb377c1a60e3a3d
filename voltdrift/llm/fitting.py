"""Small fitting helpers for models trained on a bounded sample, on the driver."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimised(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 100, memory: int = 8, tolerance: float = 1e-5
) -> np.ndarray:
    """L-BFGS with a backtracking line search; ``loss`` gives a value and its gradient."""
    x, pairs = start.astype(np.float64), []
    value, slope = loss(x)
    for _ in range(steps):
        way, alphas = slope.copy(), []
        for s, y, rho in reversed(pairs):
            alphas.append(rho * (s @ way))
            way -= alphas[-1] * y
        if pairs:
            s, y, _ = pairs[-1]
            way *= (s @ y) / (y @ y)
        for (s, y, rho), alpha in zip(pairs, reversed(alphas), strict=True):
            way += (alpha - rho * (y @ way)) * s
        down = slope @ way
        if down <= 1e-15:
            break
        step = 1.0 if pairs else min(1.0, 1.0 / (np.abs(slope).sum() + 1e-12))
        for _ in range(25):
            there, new_slope = loss(x - step * way)
            if there <= value - 1e-4 * step * down:
                break
            step /= 2
        else:
            break
        s, y = -step * way, new_slope - slope
        x, gain, value, slope = x + s, value - there, there, new_slope
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y, 1 / (s @ y))][-memory:]
        if gain < tolerance * max(1.0, abs(value)):
            break
    return x


class Rows:
    """Sparse 0/1 rows: the columns that are set, row after row."""

    def __init__(self, rows: list[np.ndarray], width: int) -> None:
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.columns = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.width = width

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(weights[self.columns])])
        return sums[self.ends[1:]] - sums[self.ends[:-1]]

    def gather(self, of_row: np.ndarray) -> np.ndarray:
        """The transpose times ``of_row``."""
        return np.bincount(self.columns, np.repeat(of_row, self.sizes), self.width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def log_loss(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, margin) - label * margin
