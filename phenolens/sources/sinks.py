"""Writers for labels and feature tuples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_labels(labels: DataFrame, path: str, fmt: str = "tsv", mode: str = "overwrite") -> None:
    """``patient_id <tab> label`` text (``fmt="tsv"``) or Parquet."""
    out = labels.select("patient_id", "label")
    _write(out, path, fmt, mode)


def write_feature_tuples(tuples: DataFrame, path: str, fmt: str = "parquet",
                         mode: str = "overwrite") -> None:
    """``patient_id <tab> feature <tab> value`` text (``fmt="tsv"``) or Parquet."""
    out = tuples.select("patient_id", "feature", "value")
    _write(out, path, fmt, mode)


def read_feature_tuples(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    """``(patient_id, feature, value)`` as :func:`write_feature_tuples` wrote them."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema("patient_id string, feature string, value double").option("sep", "\t").option("header", "false").csv(path)


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    if fmt == "tsv":
        df.write.mode(mode).option("sep", "\t").option("header", "false").csv(path)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError("fmt must be 'tsv' or 'parquet'")
