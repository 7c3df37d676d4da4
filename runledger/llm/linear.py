"""Small numeric helpers shared by the two trained scorers."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Adam:
    """Plain Adam steps for one parameter vector."""

    def __init__(self, size: int, rate: float):
        self.rate, self.t = rate, 0
        self.m, self.v = np.zeros(size), np.zeros(size)

    def step(self, w: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        w -= self.rate * (self.m / (1 - 0.9 ** self.t)) / (
            np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)
