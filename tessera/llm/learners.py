"""Small models: soft-label logistic regression on a bounded sample in the
driver or on a whole table by sums over its rows, and Platt scaling."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tasks whose sums are added up in one group before the driver adds the groups.
GROUP = 100


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Logistic:
    """Standardised logistic regression, fitted by Newton steps."""

    def __init__(self, ridge: float = 1.0):
        self.ridge = ridge

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        """``y`` may hold probabilities.  A column that never varies gets no
        weight; without rows the model answers one half."""
        x = np.asarray(x, dtype=np.float64)
        n, d = x.shape
        self.mean = x.mean(axis=0) if n else np.zeros(d)
        scale = x.std(axis=0) if n else np.zeros(d)
        self.scale = np.where(scale > 1e-9, scale, np.inf)
        z = np.hstack([(x - self.mean) / self.scale, np.ones((n, 1))])
        w = np.ones(n) if weight is None else weight
        self.coef = np.zeros(d + 1)
        penalty = np.full(d + 1, self.ridge)
        penalty[-1] = 1e-3
        for _ in range(25):
            p = sigmoid(z @ self.coef)
            grad = z.T @ (w * (p - y)) + penalty * self.coef
            hess = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            size = np.abs(step).max()
            self.coef -= step * min(1.0, 5.0 / max(size, 1e-12))
            if size < 1e-6:
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((np.asarray(x, dtype=np.float64) - self.mean) / self.scale) @ self.coef[:-1] + self.coef[-1]


def summed(rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """Sum of ``of`` (doubles, ``width`` of them) over the batches of ``rows``.

    A task adds up its batches, a group the tasks, in the order of their
    numbers, so reruns over the same partitions agree; the driver gets one row
    per ``GROUP`` tasks.
    """
    def part(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                total = of(batch) if total is None else total + of(batch)
        if total is not None:
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([at // GROUP]), pa.array([at]), pa.array([total.tobytes()])],
                                             names=["part", "task", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = sum(np.frombuffer(b) for b in table["sums"].to_pylist())
        return pa.table({"part": table["part"][:1], "sums": pa.array([total.tobytes()])})

    found = (rows.mapInArrow(part, "part long, task long, sums binary").groupBy("part")
             .applyInArrow(add, "part long, sums binary").collect())
    return sum((np.frombuffer(r.sums) for r in sorted(found)), np.zeros(width))


def fit_whole(rows: DataFrame, read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], d: int, *,
              ridge: float = 1.0, rounds: int = 25) -> Logistic:
    """``Logistic.fit`` over all of ``rows``: ``read`` gives a batch's inputs
    (``d`` columns) and targets; every Newton step is one pass of sums."""
    def moments(batch):
        x, _ = read(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    model, got = Logistic(ridge), summed(rows, moments, 2 * d + 1)
    n = got[0]
    model.mean = got[1: d + 1] / max(n, 1)
    scale = np.sqrt(np.maximum(got[d + 1:] / max(n, 1) - model.mean ** 2, 0))
    model.scale, model.coef = np.where(scale > 1e-7, scale, np.inf), np.zeros(d + 1)
    penalty = np.append(np.full(d, ridge), 1e-3)
    for _ in range(rounds if n else 0):
        def step_sums(batch, model=model, coef=model.coef):
            x, y = read(batch)
            z = np.hstack([(x - model.mean) / model.scale, np.ones((len(x), 1))])
            p = sigmoid(z @ coef)
            hess = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z
            return np.concatenate([z.T @ (p - y), hess.ravel()])

        got = summed(rows, step_sums, (d + 1) * (d + 2))
        step = np.linalg.solve(got[d + 1:].reshape(d + 1, d + 1) + np.diag(penalty), got[: d + 1] + penalty * model.coef)
        size = np.abs(step).max()
        model.coef = model.coef - step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return model


def platt(logit: np.ndarray, y: np.ndarray) -> Logistic:
    """Calibration of a view's logits on rows it was not fitted on."""
    return Logistic(ridge=0.1).fit(logit if logit.ndim == 2 else logit[:, None], y)
