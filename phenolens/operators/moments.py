"""Standardisation and covariance in long form.

Missing tuples are zeros: every moment runs over all ``n`` patients that have
any feature, not over the present tuples only.

* ``mean_i = p * m_i / n`` with ``m_i`` the mean of the ``p`` present values
* ``sd_i = sqrt(M2_i / (n - 1))`` (sample deviation) with the central moment
  ``M2_i = (p - 1) * var_i + m_i^2 * p * (n - p) / n``: Spark's ``var_samp`` of the
  present values merges without cancellation, the zeros are folded in after
* a scaled value is ``(v - mean_i) / sd_i``, or 0 for a constant feature;
  an absent tuple scales to ``zero_value = -mean_i / sd_i``.

The covariance of the scaled features is built from the Gram matrix of the
centred patient vectors, which are sparse rows. Each task folds its rows into
the blocks on and above the diagonal, with NumPy, and the blocks are added in
two grouped levels. No pairs of tuples are ever enumerated per patient, and no
row holds a single cell until the result is listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .features import BROADCAST_INDEX_MAX_ROWS, join_per_feature

#: Rows and columns of a block of the Gram matrix, and groups of tasks that are added first.
GRAM_BLOCK, GRAM_SHARES = 256, 32


def count_patients(matrix_long: DataFrame) -> int:
    return matrix_long.select("patient_id").distinct().count()


def feature_moments(matrix_long: DataFrame, n_patients: int | None = None) -> DataFrame:
    """``(idx, n_present, mean, sd, zero_value)`` per feature index."""
    if n_patients is None:
        n_patients = count_patients(matrix_long)
    n = F.lit(float(n_patients))
    # Central moments of the present values merge without cancellation; the zeros are folded in after.
    sums = matrix_long.groupBy("idx").agg(
        F.count(F.lit(1)).alias("n_present"),
        F.avg("value").alias("_m"),
        F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("_v"),
    )
    p = F.col("n_present")
    m2 = (p - 1) * F.col("_v") + F.col("_m") * F.col("_m") * p * (n - p) / n
    sd = F.sqrt(m2 / F.lit(n_patients - 1.0)) if n_patients > 1 else F.lit(0.0)
    return (
        sums.select("idx", "n_present", (F.col("_m") * p / n).alias("mean"), sd.alias("sd"))
        .withColumn(
            "zero_value",
            F.when(F.col("sd") > 0, -F.col("mean") / F.col("sd")).otherwise(F.lit(0.0)),
        )
    )


def scaled_long(matrix_long: DataFrame, moments: DataFrame, n_features: int) -> DataFrame:
    """``(patient_id, idx, value)`` standardised; present tuples only."""
    scaled = F.when(F.col("sd") > 0, (F.col("value") - F.col("mean")) / F.col("sd")).otherwise(F.lit(0.0))
    joined = join_per_feature(matrix_long, moments.select("idx", "mean", "sd"), "idx", n_features)
    return joined.select("patient_id", "idx", scaled.alias("value"))


def block_starts(n_features: int, block: int) -> list[tuple[int, int]]:
    """(first row, first column) of the blocks on and above the diagonal of an n x n matrix."""
    return [(i, j) for i in range(0, n_features, block) for j in range(i, n_features, block)]


def _gram_partials(n_features: int, center: np.ndarray, block: int):
    """mapInArrow function: upper blocks of ``sum (x - c)(x - c)'`` over a task's sparse rows."""
    starts = block_starts(n_features, block)
    # Rows made dense at a time: 8 MB at most, one row at least.
    rows_at_once = max(1, (1 << 20) // max(n_features, 1))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            indices, values = batch.column("indices"), batch.column("values")
            for lo in range(0, batch.num_rows, rows_at_once):
                own, val = indices.slice(lo, rows_at_once), values.slice(lo, rows_at_once)
                x = np.tile(-center, (len(own), 1))
                row = np.repeat(np.arange(len(own)), pc.list_value_length(own).to_numpy(zero_copy_only=False))
                x[row, own.flatten().to_numpy()] += val.flatten().to_numpy()  # an index comes once a row
                for i, j in starts:
                    part = x[:, i:i + block].T @ x[:, j:j + block]
                    sums[i, j] = sums[i, j] + part if (i, j) in sums else part
        share = hash(uuid.uuid4()) % (1 << 16)
        for (i, j), part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([share], pa.int32()),
                 pa.array([part.ravel()], pa.list_(pa.float64()))], names=["bi", "bj", "share", "cells"])

    return fold


def _sum_blocks(key: list[str]):
    """applyInArrow function: the sum of a group's blocks (one place, the tasks of one share or the shares)."""
    def add(group: pa.Table) -> pa.Table:
        total = None
        for cells in group.column("cells"):
            part = cells.values.to_numpy()
            total = part.copy() if total is None else total + part
        return pa.table({**{k: group.column(k).slice(0, 1) for k in key}, "cells": pa.array([total], pa.list_(pa.float64()))})

    return add


def gram_blocks(vectors: DataFrame, n_features: int, center: np.ndarray | None = None, block: int = GRAM_BLOCK,
                shares: int = GRAM_SHARES) -> DataFrame:
    """``(bi, bj, cells array<double>)``: blocks on and above the diagonal of ``sum (x - c)(x - c)'`` over sparse rows.

    ``cells`` is row-major, ``bi`` and ``bj`` are the block's first row and
    column. Every task folds its rows into one array for each block, so rows
    leave it by blocks, not by cells or patients. They are added in two
    grouped levels: first within each of ``shares`` groups of tasks, then over
    the groups, so that no task adds the blocks of all tasks of one place.
    ``center`` is zero if not given; with the means, nothing cancels in the sums.
    """
    center = np.zeros(n_features) if center is None else np.asarray(center, np.float64)
    partials = vectors.select("indices", "values").mapInArrow(
        _gram_partials(n_features, center, block), "bi int, bj int, share int, cells array<double>")
    first = partials.withColumn("share", F.pmod("share", F.lit(shares))).groupBy("bi", "bj", "share").applyInArrow(
        _sum_blocks(["bi", "bj", "share"]), "bi int, bj int, share int, cells array<double>")
    return first.groupBy("bi", "bj").applyInArrow(_sum_blocks(["bi", "bj"]), "bi int, bj int, cells array<double>")


def gram_long(blocks: DataFrame, n_features: int, block: int = GRAM_BLOCK) -> DataFrame:
    """``(i, j, s)`` for ``i <= j`` from ``gram_blocks``."""
    width = F.least(F.lit(block), F.lit(n_features) - F.col("bj"))
    cells = blocks.select("bi", "bj", width.alias("w"), F.posexplode("cells").alias("at", "s"))
    return cells.select((F.col("bi") + F.floor(F.col("at") / F.col("w"))).cast("int").alias("i"),
                        (F.col("bj") + F.col("at") % F.col("w")).cast("int").alias("j"), "s").where("i <= j")


def matrix_of(blocks: DataFrame, n_features: int, block: int = GRAM_BLOCK) -> np.ndarray:
    """The whole symmetric matrix on the driver, block by block (n^2 numbers; the caller bounds n)."""
    out = np.zeros((n_features, n_features))
    for r in blocks.toLocalIterator():
        i, j = r["bi"], r["bj"]
        cells = np.asarray(r["cells"]).reshape(min(block, n_features - i), min(block, n_features - j))
        out[i:i + cells.shape[0], j:j + cells.shape[1]] = cells
        out[j:j + cells.shape[1], i:i + cells.shape[0]] = cells.T
    return out


def moment_arrays(moments: DataFrame, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, sd) of every feature on the driver: model parameters, two numbers a feature."""
    mean, sd = np.zeros(n_features), np.zeros(n_features)
    got = moments.select("idx", "mean", "sd").toArrow()
    idx = got.column("idx").to_numpy()
    mean[idx], sd[idx] = got.column("mean").to_numpy(), got.column("sd").to_numpy()
    return mean, sd


def feature_covariance(vectors: DataFrame, moments: DataFrame, n_patients: int,
                       n_features: int) -> DataFrame:
    """``(i, j, covariance)`` of the standardised features, ``i <= j``, from sparse vectors.

    Equals the Pearson correlation of the raw columns, with 0 wherever a
    feature is constant.
    """
    # Read three times (for the centre, i and j): written once, one row per feature.
    moments = materialize(moments.select("idx", "mean", "sd"), "moments")
    side = F.broadcast(moments) if n_features <= BROADCAST_INDEX_MAX_ROWS else moments
    mi = side.select(F.col("idx").alias("i"), F.col("sd").alias("sd_i"))
    mj = side.select(F.col("idx").alias("j"), F.col("sd").alias("sd_j"))
    center, _ = moment_arrays(moments, n_features)
    cov = F.col("s") / F.lit(max(float(n_patients) - 1.0, 1.0))
    denom = F.col("sd_i") * F.col("sd_j")
    return (
        gram_long(gram_blocks(vectors, n_features, center), n_features)
        .join(mi, "i")
        .join(mj, "j")
        .select("i", "j", F.when(denom > 0, cov / denom).otherwise(F.lit(0.0)).alias("covariance"))
    )
