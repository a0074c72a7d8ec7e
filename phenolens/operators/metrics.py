"""Cluster purity: ``(1/N) * sum over clusters of the largest class count``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def purity(pairs: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """One row ``(n_pairs bigint, purity double)``.

    Three aggregations, each tiny after the first: counts per (cluster,
    class), the largest per cluster, then the global sums. No pairs gives
    ``n_pairs = 0`` and a null purity.
    """
    counts = pairs.groupBy(cluster_col, label_col).agg(F.count(F.lit(1)).alias("_n"))
    per_cluster = counts.groupBy(cluster_col).agg(
        F.max("_n").alias("_top"), F.sum("_n").alias("_total"))
    return per_cluster.agg(
        F.coalesce(F.sum("_total"), F.lit(0)).cast("bigint").alias("n_pairs"),
        F.try_divide(F.sum("_top").cast("double"), F.sum("_total").cast("double")).alias("purity"),
    )


def paired_by_patient(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Cluster and rule-based label of the same patient: ``(patient_id, cluster, label)``.

    Patients are paired by id (inner join), never by position.
    """
    return clusters.select("patient_id", "cluster").join(
        labels.select("patient_id", "label"), "patient_id")


def pairing(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each patient with a cluster or a label: ``(patient_id, cluster, label)``, null where one is missing.

    The two tables are stacked and folded by one grouping, which is a full
    outer join by patient without a join. A patient comes once in either
    table; null patients are no patients.
    """
    kind = lambda df, c: df.schema[c].dataType
    stacked = clusters.select("patient_id", "cluster", F.lit(None).cast(kind(labels, "label")).alias("label")).unionByName(
        labels.select("patient_id", F.lit(None).cast(kind(clusters, "cluster")).alias("cluster"), "label"))
    return stacked.where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.max("cluster").alias("cluster"), F.max("label").alias("label"))


def paired_purity(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """One row ``(n_pairs, n_unmatched_clusters, n_unmatched_labels, purity)``.

    Purity runs over the patients with both; the others are counted beside
    it, by where they are found. The counts per (cluster, label) fold all
    patients once, with a null for the missing side.
    """
    counts = pairing(clusters, labels).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("_n"))
    both = F.col("cluster").isNotNull() & F.col("label").isNotNull()
    per_cluster = counts.groupBy("cluster").agg(
        F.max(F.when(both, F.col("_n"))).alias("_top"),
        F.sum(F.when(both, F.col("_n"))).alias("_total"),
        F.sum(F.when(F.col("label").isNull(), F.col("_n"))).alias("_alone"),
        F.sum(F.when(F.col("cluster").isNull(), F.col("_n"))).alias("_missed"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_cluster.agg(
        count("_total").alias("n_pairs"), count("_alone").alias("n_unmatched_clusters"), count("_missed").alias("n_unmatched_labels"),
        F.try_divide(F.sum("_top").cast("double"), F.sum("_total").cast("double")).alias("purity"))
