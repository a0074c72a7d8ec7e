"""Principal components of many features, without an n x n matrix anywhere.

Randomised subspace iteration over the long form. With Z the standardised
rows (an absent tuple is ``-mean / sd``) and Q an n x l matrix with
orthonormal columns (l = k + ``OVERSAMPLE``), a pass computes ``Z' (Z Q)``:

1. a keyed sum by patient: ``y_p = sum_i (x_pi / sd_i) Q_i - sum_i (mean_i / sd_i) Q_i``;
2. a keyed sum by feature: ``b_i = (sum_p x_pi y_p - mean_i sum_p y_p) / sd_i``.

Q and b are tables of n rows; the sums ``Q'(mean / sd)``, ``sum y`` and the l x l
matrices b'b and Q'b are aggregates, and only these l-wide numbers reach the
driver. The next Q is ``b (R^-1)`` with R the Cholesky factor of b'b, applied row
by row. The passes end when the l x l projected matrix's first k values stand
still, and the eigenvectors of Q'Z'ZQ turn Q into components. Each pass is
written, so a lost executor repeats one pass at most.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.features import join_per_feature
from ..operators.moments import moment_arrays
from ..session import materialize

OVERSAMPLE = 10
MAX_PASSES = 60
TOLERANCE = 1e-9


@dataclass
class LinearProjection:
    """Scaler + PCA parameters: per-feature mean and sd, and the features x k PC matrix."""

    mean: np.ndarray
    std: np.ndarray
    pc: np.ndarray
    explained_variance: np.ndarray | None = None

    @classmethod
    def from_pipeline(cls, model: PipelineModel) -> LinearProjection:
        scaler, pca = model.stages[0], model.stages[1]
        return cls(scaler.mean.toArray(), scaler.std.toArray(), pca.pc.toArray(),
                   pca.explainedVariance.toArray())


def _sums(column: str, width: int, factor: Column | None = None) -> list[Column]:
    """One sum for each place of an array column."""
    each = [F.col(column)[d] for d in range(width)]
    return [F.sum(x if factor is None else factor * x).alias(f"s{d}") for d, x in enumerate(each)]


def _packed(width: int, name: str, shift: np.ndarray | None = None) -> Column:
    return F.array(*[F.col(f"s{d}") + (0.0 if shift is None else F.lit(float(shift[d]))) for d in range(width)]).alias(name)


def _cross(table: DataFrame, left: str, right: str, width: int) -> np.ndarray:
    """The l x l matrix of sums of products of two array columns."""
    sums = table.agg(*[F.sum(F.col(left)[i] * F.col(right)[j]).alias(f"c{i}_{j}") for i in range(width) for j in range(width)]).first()
    return np.array([[sums[f"c{i}_{j}"] or 0.0 for j in range(width)] for i in range(width)])


def _turned(column: str, matrix: np.ndarray) -> Column:
    """An array column times a small matrix."""
    rows, columns = matrix.shape
    return F.array(*[sum((F.col(column)[i] * F.lit(float(matrix[i, j])) for i in range(1, rows)), F.col(column)[0] * F.lit(float(matrix[0, j])))
                     for j in range(columns)])


def _orthonormal(table: DataFrame, width: int) -> DataFrame:
    """``q``: the columns of the array column ``b`` made orthonormal (twice, as once loses digits)."""
    for _ in range(2):
        factor = np.linalg.cholesky(_cross(table, "b", "b", width))
        table = materialize(table.withColumn("b", _turned("b", np.linalg.inv(factor).T)), "subspace")
    return table.withColumnRenamed("b", "q")


def fit_subspace(matrix_long: DataFrame, moments: DataFrame, n_patients: int, n_features: int, k: int,
                 oversample: int = OVERSAMPLE, max_passes: int = MAX_PASSES, tolerance: float = TOLERANCE,
                 seed: int = 7) -> LinearProjection:
    """Mean, sd and the first k components of the standardised rows of ``(patient_id, idx, value)``."""
    width = min(k + oversample, n_features)
    weight = F.when(F.col("sd") > 0, 1 / F.col("sd")).otherwise(F.lit(0.0))
    scale = materialize(moments.select("idx", "mean", weight.alias("w")), "scale")
    live = scale.where("w > 0").count()
    if live < k:
        raise ValueError(f"PCA with k={k} needs at least {k} features that vary, got {live}")
    width = min(width, live)
    start = F.array(*[F.when(F.col("w") > 0, (F.pmod(F.xxhash64("idx", F.lit(seed + d)), F.lit(2_000_003)) / 1_000_001.5 - 1))
                      .otherwise(0.0) for d in range(width)])
    q = _orthonormal(scale.withColumn("b", start), width)
    found = np.zeros(k)
    for _ in range(max_passes):
        offset = np.array([x or 0.0 for x in q.agg(*_sums("q", width, F.col("mean") * F.col("w"))).first()])
        weighted = q.select("idx", F.transform("q", lambda x: x * F.col("w")).alias("q"))
        y = materialize(join_per_feature(matrix_long, weighted, "idx", n_features).groupBy("patient_id")
                        .agg(*_sums("q", width, F.col("value"))).select("patient_id", _packed(width, "y", -offset)), "projected")
        total = np.array([x or 0.0 for x in y.agg(*_sums("y", width)).first()])
        back = (matrix_long.join(y, "patient_id").groupBy("idx").agg(*_sums("y", width, F.col("value")))
                .select("idx", _packed(width, "x")))
        centred = F.array(*[(F.coalesce(F.col("x")[d], F.lit(0.0)) - F.col("mean") * F.lit(float(total[d]))) * F.col("w") / (n_patients - 1.0)
                            for d in range(width)])
        step = materialize(q.join(back, "idx", "left").select("idx", "mean", "w", "q", centred.alias("b")), "subspace")
        projected = _cross(step, "q", "b", width)
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
        done = np.abs(values - found).max() <= tolerance * max(values[0], 1e-300)
        found = values
        if done:
            break
        q = _orthonormal(step.select("idx", "mean", "w", "b"), width)
    mean, std = moment_arrays(moments, n_features)
    pc = np.zeros((n_features, k))
    for r in step.select("idx", _turned("q", turn).alias("c")).toLocalIterator():  # the model: k numbers a feature
        pc[r["idx"]] = r["c"]
    return LinearProjection(mean, std, pc, found / live if live else None)
