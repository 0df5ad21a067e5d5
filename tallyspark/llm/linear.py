"""Sparse linear models trained by follow-the-regularised-leader with elastic-net penalties."""

from __future__ import annotations

import numpy as np


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Per-coordinate FTRL-proximal for multinomial (k > 1) or binary (k = 1) logistic loss.

    Rows are (indices, values); the last index, dim, is the bias and isn't penalised.
    """

    def __init__(self, dim: int, k: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.dim, self.k, self.alpha, self.beta, self.l1, self.l2 = dim, k, alpha, beta, l1, l2
        self.z, self.n = np.zeros((dim + 1, k)), np.zeros((dim + 1, k))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.arange(self.dim + 1)[at] == self.dim, 0.0, self.l1)[:, None]
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, seed: int = 1) -> Ftrl:
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                at, x = np.append(rows[i][0], self.dim), np.append(rows[i][1], 1.0)
                w = self.weights(at)
                logit = x @ w
                if self.k == 1:
                    error = sigmoid(logit) - labels[i]
                else:
                    error = softmax(logit)
                    error[labels[i]] -= 1.0
                g = x[:, None] * error[None, :]
                n = self.n[at]
                self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
                self.n[at] = n + g * g
        return self


def lists(column) -> list[np.ndarray]:
    """The rows of an Arrow list column as views of one array."""
    column = column.combine_chunks()
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def logits(rows: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> np.ndarray:
    return np.array([x @ weights[at] + weights[-1] for at, x in rows]).reshape(len(rows), weights.shape[1])


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm; 1 without rows.

    The labels are smoothed by one row's worth of doubt, so that rows without an error don't give endless certainty.
    """
    if not len(labels):
        return 1.0

    def loss(t):
        p = np.log(np.maximum(softmax(scores / np.exp(t)), 1e-300))
        own = p[np.arange(len(labels)), labels]
        doubt = 1 / (len(labels) + 1)
        return -((1 - doubt) * own + doubt * (p.sum(1) - own) / max(1, p.shape[1] - 1)).mean()

    low, high, g = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
