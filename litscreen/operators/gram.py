"""Weighted Gram matrices of feature vectors, and linear models from them.

A linear model with squared loss needs of its rows only sums of products of features and targets. These are added up
in one pass, for several weightings of the rows at once; the models of all weightings and targets, and all steps of
gradient descent over fixed batches, come from these sums. Their size depends on the number of features alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024  # rows that are multiplied at once
BLOCK_ROWS = 128  # rows of a matrix that move together


@dataclass(frozen=True)
class Sums:
    """Weighted sums of products over rows of (features, 1, targets): a square matrix of that order."""

    products: np.ndarray
    targets: int

    @property
    def width(self) -> int:
        return len(self.products) - self.targets - 1

    @property
    def weight(self) -> float:
        return float(self.products[self.width, self.width])

    def means(self) -> np.ndarray:
        return self.products[self.width] / self.weight

    def loss(self, target: int, weights: np.ndarray, bias: float) -> float:
        """The mean squared error of a linear model."""
        v = self._signed(target, weights, bias)
        return float(v @ self.products @ v) / self.weight

    def slope(self, target: int, weights: np.ndarray, bias: float) -> np.ndarray:
        """The gradient of the loss by the weights and the bias."""
        pulled = self.products @ self._signed(target, weights, bias)
        return 2 * pulled[: self.width + 1] / self.weight

    def _signed(self, target: int, weights: np.ndarray, bias: float) -> np.ndarray:
        v = np.zeros(len(self.products))
        v[: self.width], v[self.width], v[self.width + 1 + target] = weights, bias, -1.0
        return v

    def ridge(self, target: int, regularisation: float) -> tuple[np.ndarray, float]:
        """Weights and bias of least squares on standardised features and target, with an L2 penalty.

        A feature that does not vary has no weight; the target that does not has its mean as the bias.
        """
        d, at = self.width, self.width + 1 + target
        mean = self.means()
        covariance = self.products / self.weight - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(covariance), 0.0))
        if spread[at] < 1e-12:
            return np.zeros(d), float(mean[at])
        varies = spread[:d] > 1e-12
        scale = np.where(varies, spread[:d], 1.0)
        system = np.where(np.outer(varies, varies), covariance[:d, :d] / np.outer(scale, scale), 0.0)
        system[np.diag_indices(d)] += np.where(varies, regularisation / spread[at], 1.0)
        right = np.where(varies, covariance[:d, at] / scale / spread[at], 0.0)
        weights = np.linalg.solve(system, right) * spread[at] / scale
        return weights, float(mean[at] - weights @ mean[:d])


def weighted_sums(rows: DataFrame, vector: str, targets: list[Column], weightings: list[Column]) -> list[Sums]:
    """The sums of each weighting, in one pass over the rows.

    Each task multiplies its rows in chunks and gives one matrix for each weighting, in blocks of its rows; blocks of
    the same place are added where they meet. What comes to the driver is one matrix for each weighting.
    """
    many = len(weightings)
    packed = rows.select(
        vector_to_array(vector).alias("x"), F.array(*[t.cast("double") for t in targets]).alias("y"),
        F.array(*[w.cast("double") for w in weightings]).alias("w"))

    def as_matrix(column: pa.Array, rows: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                n = part.num_rows
                x, y, w = (as_matrix(part.column(i), n) for i in range(3))
                wide = np.concatenate([x, np.ones((n, 1)), y], axis=1)
                if sums is None:
                    sums = np.zeros((many, wide.shape[1], wide.shape[1]))
                for k in range(many):
                    has = w[:, k] != 0
                    some = wide[has]
                    sums[k] += (some * w[has, k:k + 1]).T @ some
        if sums is not None:
            yield from _blocks({(k, at): sums[k, at:at + BLOCK_ROWS] for k in range(many) for at in range(0, sums.shape[1], BLOCK_ROWS)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, at, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                block = np.frombuffer(data)
                found[k, at] = found[k, at] + block if (k, at) in found else block
        yield from _blocks(found)

    schema = "weighting int, at int, block binary"
    added = packed.mapInArrow(multiply, schema).repartition("weighting", "at").mapInArrow(add, schema)
    found: list[list[np.ndarray]] = [[] for _ in weightings]
    for row in sorted(added.collect(), key=lambda r: (r.weighting, r.at)):
        found[row.weighting].append(np.frombuffer(row.block))
    return [Sums(_square(np.concatenate(blocks)), len(targets)) for blocks in found if blocks]


def _square(values: np.ndarray) -> np.ndarray:
    return values.reshape(int(round(len(values) ** 0.5)), -1)


def _blocks(found: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (k, at), block in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([at], pa.int32()), pa.array([block.tobytes()], pa.binary())],
            names=["weighting", "at", "block"])


def descend(batches: list[Sums], target: int, epochs: int, rate: float) -> Iterator[tuple[float, np.ndarray, float]]:
    """Gradient descent over the batches, from zero: loss, weights and bias after each epoch.

    Each step follows the gradient of one batch. The loss of an epoch is the mean of the losses of its batches, each
    before its step.
    """
    weights, bias = np.zeros(batches[0].width), 0.0
    for _ in range(epochs):
        total = 0.0
        for batch in batches:
            total += batch.loss(target, weights, bias)
            slope = batch.slope(target, weights, bias)
            weights, bias = weights - rate * slope[:-1], bias - rate * float(slope[-1])
        yield total / len(batches), weights, bias
