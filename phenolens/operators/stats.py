"""Group statistics of lab values by phenotype label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lab_mean_by_label(lab: DataFrame, labels: DataFrame, test: str) -> DataFrame:
    """Mean value of one test (exact lower-cased name) per label.

    ``(label int, mean_value double, n_rows bigint)``. A label with no such
    test has no row. Lab rows are first folded to one (sum, count) per
    patient, so the join to the labels moves one row per patient however
    many results a single patient has; the mean is the ratio of the totals.
    """
    per_patient = (
        lab.where(F.lower(F.col("test_name")) == F.lit(test.lower()))
        .groupBy("patient_id")
        .agg(F.sum("value").alias("_sum"), F.count("value").alias("_n"))
    )
    return (
        per_patient.join(labels.select("patient_id", "label"), "patient_id")
        .groupBy("label")
        .agg(
            (F.sum("_sum") / F.sum("_n")).alias("mean_value"),
            F.sum("_n").alias("n_rows"),
        )
    )
