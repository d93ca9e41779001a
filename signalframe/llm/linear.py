"""Sparse rows and the two linear models that are fitted on bounded samples of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts into which a sample divides the hash of an id.
_PARTS = 1 << 24


def drawn(ids: Column, share: float) -> Column:
    """Whether the hash of an id is among the given share of all hashes."""
    return F.pmod(F.xxhash64(ids, F.lit("sample")), F.lit(_PARTS)) < int(min(1.0, share) * _PARTS)


class Rows:
    """Sparse rows: parallel arrays of row number, column and value."""

    def __init__(self, indices: list[np.ndarray], values: list[np.ndarray], columns: int):
        self.n, self.columns = len(indices), columns
        self.row = np.repeat(np.arange(self.n), [len(x) for x in indices])
        self.column = np.concatenate([*indices, np.empty(0, np.int64)]).astype(np.int64)
        self.value = np.concatenate([*values, np.empty(0)]).astype(float)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.n)

    def gathered(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * errors[self.row], self.columns)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def adagrad(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Descend ``gradient`` with a step for each coordinate that shrinks as its gradients add up."""
    x, squares = start.copy(), np.full(len(start), 1e-8)
    for _ in range(steps):
        g = gradient(x)
        squares += g * g
        x -= rate * g / np.sqrt(squares)
    return x


def fit_logistic(rows: Rows, target: np.ndarray, penalty: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights, then the intercept, of a logistic regression on targets between 0 and 1."""

    def gradient(x: np.ndarray) -> np.ndarray:
        error = (sigmoid(rows.times(x[:-1]) + x[-1]) - target) / max(1, rows.n)
        return np.append(rows.gathered(error) + penalty * x[:-1], error.sum())

    return adagrad(gradient, np.zeros(rows.columns + 1), steps, 0.5)


def fit_cumulative(rows: Rows, grade: np.ndarray, grades: int, weight: np.ndarray, penalty: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of P(grade > k) = sigmoid(weights . row - threshold k).

    All thresholds share the weights.  The likelihood of a grade is the
    difference of two neighbouring sigmoids.  Thresholds are kept in order by
    fitting the first and the logarithms of the gaps.
    """
    cuts, c = grades - 1, rows.columns

    def thresholds(x: np.ndarray) -> np.ndarray:
        return x[c] + np.concatenate([[0.0], np.cumsum(np.exp(x[c + 1 :]))])

    def gradient(x: np.ndarray) -> np.ndarray:
        theta = thresholds(x)
        above = sigmoid(rows.times(x[:c])[:, None] - theta)  # P(grade > k)
        high = np.hstack([np.ones((rows.n, 1)), above])[np.arange(rows.n), grade]  # P(grade >= own)
        low = np.hstack([above, np.zeros((rows.n, 1))])[np.arange(rows.n), grade]  # P(grade > own)
        p = np.maximum(high - low, 1e-12)
        scale = weight / weight.sum()
        up, down = high * (1 - high) / p * scale, low * (1 - low) / p * scale
        by_cut = np.zeros((rows.n, cuts + 2))  # likelihood by threshold k sits at k + 1
        by_cut[np.arange(rows.n), grade] += up
        by_cut[np.arange(rows.n), grade + 1] -= down
        by_theta = by_cut[:, 1:-1].sum(axis=0)
        gaps = np.cumsum(by_theta[::-1])[::-1][1:] * np.exp(x[c + 1 :])
        return np.concatenate([rows.gathered(down - up) + penalty * x[:c], [by_theta.sum()], gaps])

    x = adagrad(gradient, np.zeros(c + cuts), steps, 0.5)
    return x[:c], thresholds(x)


def in_one_task(sample: DataFrame, fit, schema: str) -> DataFrame:
    """Run ``fit`` (pandas frame to pandas frame) on a sample whose bound is a parameter of the operator."""
    return sample.groupBy(F.lit(0).alias("_all")).applyInPandas(lambda frame: fit(frame), schema)
