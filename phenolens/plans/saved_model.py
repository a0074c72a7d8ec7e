"""A fitted scaler + PCA with its dictionary as a versioned table, and scoring of new patients with it.

A version is a folder ``version=N`` with one row a feature: ``(feature string,
mean double, sd double, pc array<double>)``. Names, not indices, tie the model
to new data, so new tuples need no dictionary of their own: they are joined by
name, and names that the model has not seen drop out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import join_per_feature
from .subspace import LinearProjection

SCHEMA = "feature string, mean double, sd double, pc array<double>"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The version numbers stored under ``path``, rising."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    # A version that was not written to its end has no _SUCCESS mark and does not count.
    whole = [n for n in names if n.startswith("version=") and fs.exists(root.suffix(f"/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in whole)


def save_model(model: LinearProjection, index: DataFrame, path: str) -> int:
    """Store the model with the dictionary ``(feature, idx)`` as a new version; its number."""
    spark = index.sparkSession
    version = max(versions(spark, path), default=0) + 1
    rows = spark.createDataFrame(
        [(i, float(model.mean[i]), float(model.std[i]), model.pc[i].tolist()) for i in range(len(model.mean))],
        "idx int, mean double, sd double, pc array<double>")
    index.join(rows, "idx").select("feature", "mean", "sd", "pc").write.mode("error").parquet(f"{path.rstrip('/')}/version={version}")
    return version


def load_model(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (the newest if none is named)."""
    stored = versions(spark, path)
    if not stored or version is not None and version not in stored:
        raise ValueError(f"no version {version or ''} under {path}; stored: {stored}")
    return spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/version={version or stored[-1]}")


def score_new(model: DataFrame, tuples: DataFrame) -> DataFrame:
    """``(patient_id, pca array<double>)`` of the patients with at least one tuple of a name that the model knows.

    An absent feature is a zero, so it adds ``-mean / sd`` times its components;
    that constant is taken off once for each patient. Repeated names of a
    patient (one name in two domains) add up, as in the fit.
    """
    scale = F.when(F.col("sd") > 0, 1 / F.col("sd")).otherwise(F.lit(0.0))
    n = model.count()
    weighted = model.select("feature", "mean", F.transform("pc", lambda x: x * scale).alias("w"))
    width = len((weighted.select("w").first() or {"w": []})["w"])
    if not width:
        raise ValueError("the model has no components")
    sums = [F.sum(F.col("mean") * F.col("w")[d]).alias(f"o{d}") for d in range(width)]
    offset = np.array([x or 0.0 for x in weighted.agg(*sums).first()])
    parts = join_per_feature(tuples, weighted.select("feature", "w"), "feature", n)
    added = parts.groupBy("patient_id").agg(*[F.sum(F.col("value") * F.col("w")[d]).alias(f"s{d}") for d in range(width)])
    return added.select("patient_id", F.array(*[F.col(f"s{d}") - F.lit(float(offset[d])) for d in range(width)]).alias("pca"))
