"""Purity."""

import pytest

from phenolens.operators import metrics


def pairs(spark, rows):
    return spark.createDataFrame(rows, "cluster int, label int")


def test_purity_five_sixths(spark):
    rows = [(0, 1)] * 3 + [(0, 2)] + [(1, 2)] * 2
    r = metrics.purity(pairs(spark, rows)).first()
    assert r.n_pairs == 6 and r.purity == pytest.approx(5 / 6)


def test_purity_empty_is_null(spark):
    r = metrics.purity(pairs(spark, [])).first()
    assert r.n_pairs == 0 and r.purity is None


def test_purity_invariant_to_cluster_renaming(spark):
    rows = [(0, 1), (0, 1), (1, 2), (2, 3), (2, 1)]
    renamed = [(c + 7, lab) for c, lab in rows]
    a = metrics.purity(pairs(spark, rows)).first().purity
    b = metrics.purity(pairs(spark, renamed)).first().purity
    assert a == b and 1 / 3 <= a <= 1


def test_pairing_counts_unmatched_patients(spark):
    clusters = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("d", 1), (None, 1)], "patient_id string, cluster int")
    labels = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("x", 1), ("y", 2), (None, 2)], "patient_id string, label int")
    r = metrics.paired_purity(clusters, labels).first()
    assert (r.n_pairs, r.n_unmatched_clusters, r.n_unmatched_labels) == (3, 1, 2) and abs(r.purity - 2 / 3) < 1e-12
    empty = metrics.paired_purity(clusters.limit(0), labels.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, None)
    one_side = metrics.paired_purity(clusters, labels.limit(0)).first()
    assert tuple(one_side) == (0, 4, 0, None)
