"""Small linear classifiers trained in numpy: over hashed n-gram sets, and over dense columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from bondscope.llm.language import CELLS


def softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


@dataclass
class SetClassifier:
    """Class values of a text from the cells present in it, each weighing one over the root of their number."""

    weights: np.ndarray
    offset: np.ndarray

    def values(self, cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sizes = np.diff(starts)
        out = np.zeros((len(sizes), len(self.offset)), np.float32)
        filled = np.flatnonzero(sizes)
        if len(filled):
            out[filled] = np.add.reduceat(self.weights[cells], starts[filled], axis=0)
        return out / np.sqrt(np.maximum(sizes, 1))[:, None] + self.offset


def train_sets(
    sets: list[np.ndarray], labels: np.ndarray, classes: int, epochs: int = 4, rate: float = 0.5, seed: int = 5
) -> SetClassifier:
    """Softmax regression by Adagrad on small groups of texts; ``labels`` are class numbers."""
    model = SetClassifier(np.zeros((CELLS, classes), np.float32), np.zeros(classes, np.float32))
    seen, seen_offset = np.full((CELLS, classes), 1e-4, np.float32), np.full(classes, 1e-2, np.float32)
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        order = draw.permutation(len(sets))
        for at in range(0, len(order), 32):
            rows = order[at : at + 32]
            lengths = np.array([len(sets[r]) for r in rows])
            cells = np.concatenate([sets[r] for r in rows])
            starts = np.concatenate([[0], np.cumsum(lengths)])
            miss = softmax(model.values(cells, starts))
            miss[np.arange(len(rows)), labels[rows]] -= 1
            miss /= len(rows)
            used, place = np.unique(cells, return_inverse=True)
            scaled = np.repeat(miss / np.sqrt(np.maximum(lengths, 1))[:, None], lengths, axis=0)
            grad = np.stack([np.bincount(place, weights=scaled[:, k], minlength=len(used)) for k in range(classes)], axis=1)
            seen[used] += (grad * grad).astype(np.float32)
            model.weights[used] -= (rate * grad / np.sqrt(seen[used])).astype(np.float32)
            total = miss.sum(axis=0)
            seen_offset += total * total
            model.offset -= (rate * total / np.sqrt(seen_offset)).astype(np.float32)
    return model


@dataclass
class DenseClassifier:
    """Two-class log odds from standardised columns."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    def odds(self, columns: np.ndarray) -> np.ndarray:
        return np.clip((columns - self.centre) / self.scale, -6, 6) @ self.weights + self.offset


def train_dense(columns: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> DenseClassifier:
    """Logistic regression by Newton steps."""
    centre, scale = columns.mean(axis=0), columns.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.column_stack([np.clip((columns - centre) / scale, -6, 6), np.ones(len(columns))])
    at = newton(x, labels, ridge)
    return DenseClassifier(centre, scale, at[:-1], float(at[-1]))


def newton(x: np.ndarray, target: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression; the last column is not penalised."""
    at = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(x))
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, x.T @ (p - target) + penalty * at)
        at -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return at
