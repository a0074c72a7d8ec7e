"""Fits whose result is determined: k-means from given centres and Gaussian mixtures from given parameters.

Both keep the model on the driver (k centres, or k means and covariance
matrices) and read the points once an iteration. Nothing is drawn at random
and no result depends on how rows are dealt, so a fit can be repeated and
checked step by step.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.kmeans import assign, batch_statistics, centres_frame

KMEANS_ITERATIONS, KMEANS_TOLERANCE = 20, 1e-4
MIXTURE_ITERATIONS, MIXTURE_TOLERANCE = 100, 0.01
#: Added to the diagonal of every covariance matrix, so that a component of few points stays regular.
RIDGE = 1e-6


@dataclass
class CentreModel:
    centres: list[list[float]]
    sizes: list[float]
    iterations: int

    def predict(self, points: DataFrame, features_col: str = "features") -> DataFrame:
        """``points`` with ``cluster``, the number of the nearest centre (ties: the lowest)."""
        return assign(points, centres_frame(points.sparkSession, self.centres, 1.0), features_col)


def kmeans_from(points: DataFrame, centres: Sequence[Sequence[float]], iterations: int = KMEANS_ITERATIONS,
                tolerance: float = KMEANS_TOLERANCE, features_col: str = "features") -> CentreModel:
    """Lloyd's iterations from the given centres, until no centre moves more than ``tolerance``.

    Each iteration is one pass: nearest centres by row expressions and one
    grouped sum a cluster, combined before its shuffle. A centre without
    points stays where it is.
    """
    own, sizes, k = [[float(x) for x in c] for c in centres], [0.0] * len(centres), 0
    dim = len(own[0])
    for k in range(1, iterations + 1):
        stats = batch_statistics(assign(points, centres_frame(points.sparkSession, own, 1.0), features_col), dim, features_col)
        new, sizes = [list(c) for c in own], [0.0] * len(own)
        for r in stats.collect():  # k rows
            new[r["cluster"]], sizes[r["cluster"]] = [s / r["m"] for s in r["sums"]], r["m"]
        moved = max(sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for x, y in zip(own, new, strict=True))
        own = new
        if moved <= tolerance ** 2:
            break
    return CentreModel(own, sizes, k)


@dataclass
class Mixture:
    """Weights (k), means (k, d) and covariance matrices (k, d, d)."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    @classmethod
    def around(cls, means: Sequence[Sequence[float]]) -> Mixture:
        """Equal weights and unit covariance around the given means."""
        means = np.asarray(means, np.float64)
        return cls(np.full(len(means), 1 / len(means)), means, np.tile(np.eye(means.shape[1]), (len(means), 1, 1)))

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        """log(weight * density) of every row (n, k), by triangular solves with the Cholesky factors."""
        out = np.empty((len(x), len(self.weights)))
        for k, (w, mean, cov) in enumerate(zip(self.weights, self.means, self.covariances, strict=True)):
            factor = np.linalg.cholesky(cov)
            z = np.linalg.solve(factor, (x - mean).T)
            out[:, k] = np.log(max(w, 1e-300)) - (z * z).sum(0) / 2 - np.log(np.diag(factor)).sum() - len(mean) * np.log(2 * np.pi) / 2
        return out


def _responsibilities(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(responsibilities, log likelihood of each row), with the largest term taken out of the sum."""
    top = logs.max(1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(logs - top).sum(1))
    return np.exp(logs - total[:, None]), total


def _points(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def moments_of_components(points: DataFrame, model: Mixture, features_col: str = "features") -> DataFrame:
    """``(component, n, likelihood, first array, second array)``: weighted sums about the model's means, one row a component.

    A task sends one row a component, and the rows are added by component; sums about the present
    means keep their digits where the points lie far from the origin. ``second`` has d * d cells.
    """
    shared = points.sparkSession.sparkContext.broadcast(model)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k, d = m.means.shape
        n, first, second, likelihood = np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d)), 0.0
        for batch in batches:
            if batch.num_rows:
                x = _points(batch.column("x"))
                r, total = _responsibilities(m.log_densities(x))
                likelihood += total.sum()
                for c in range(k):
                    y = x - m.means[c]
                    n[c] += r[:, c].sum()
                    first[c] += r[:, c] @ y
                    second[c] += (r[:, c, None] * y).T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(n), pa.array([likelihood] * k), pa.array(list(first)),
             pa.array(list(second.reshape(k, d * d)))], names=["component", "n", "likelihood", "first", "second"])

    def add(group: pa.Table) -> pa.Table:
        total = lambda name: np.sum([np.asarray(v.as_py()) for v in group.column(name)], axis=0)
        return pa.table({"component": group.column("component").slice(0, 1), "n": pa.array([total("n")]),
                         "likelihood": pa.array([total("likelihood")]), "first": pa.array([total("first")]),
                         "second": pa.array([total("second")])})

    kind = "component int, n double, likelihood double, first array<double>, second array<double>"
    return (points.select(F.col(features_col).alias("x")).mapInArrow(fold, kind)
            .groupBy("component").applyInArrow(add, kind))


def em_step(points: DataFrame, model: Mixture, features_col: str = "features", ridge: float = 0.0) -> tuple[Mixture, float]:
    """(the model after one step, mean log likelihood of the points under the given one)."""
    rows = sorted(moments_of_components(points, model, features_col).collect(), key=lambda r: r["component"])  # k rows
    k, d = model.means.shape
    n = np.array([r["n"] for r in rows])
    if not rows or n.sum() == 0:
        raise ValueError("no points")
    held = np.maximum(n, 1e-300)[:, None]
    shift = np.array([r["first"] for r in rows]) / held
    second = np.array([r["second"] for r in rows]).reshape(k, d, d) / held[:, :, None]
    covariances = second - shift[:, :, None] * shift[:, None, :] + ridge * np.eye(d)
    return Mixture(n / n.sum(), model.means + shift, covariances), rows[0]["likelihood"] / n.sum()


def fit_mixture(points: DataFrame, start: Mixture, iterations: int = MIXTURE_ITERATIONS, tolerance: float = MIXTURE_TOLERANCE,
                features_col: str = "features", ridge: float = RIDGE) -> tuple[Mixture, list[float]]:
    """EM from the given parameters until the mean log likelihood gains less than ``tolerance``; the model and the gains' track."""
    model, track = start, []
    for _ in range(iterations):
        model, likelihood = em_step(points, model, features_col, ridge)
        track.append(likelihood)
        if len(track) > 1 and track[-1] - track[-2] < tolerance:
            break
    return model, track


def predict_mixture(points: DataFrame, model: Mixture, features_col: str = "features") -> DataFrame:
    """``points`` with ``cluster``, the component of the largest responsibility (ties: the lowest)."""
    shared = points.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _points(batch.column(features_col))
            best = shared.value.log_densities(x).argmax(1) if len(x) else np.zeros(0)
            yield batch.append_column("cluster", pa.array(best.astype(np.int32)))

    return points.mapInArrow(run, points.withColumn("cluster", F.lit(0)).schema)
