"""Feature tuples, index, long matrix, moments and covariance."""

import numpy as np
import pytest

from helpers import tables
from phenolens.operators import features, moments
from phenolens.plans.clustering import build_feature_space
from phenolens.rules import SYNTHETIC_ALLOWED_CODES, SYNTHETIC_ALLOWED_DRUGS, SYNTHETIC_ALLOWED_LABS
from phenolens.sources import synthetic_event_tables


def small(spark):
    return tables(
        spark,
        dx=[("p1", "250.02", "2010-01-01"), ("p1", "250.02", "2010-01-02"), ("p2", "401.9", "2010-01-01")],
        med=[("p1", "2010-01-01", "Lantus"), ("p2", "2010-01-01", "glucose")],
        lab=[("p1", "2010-01-01", "glucose", 100.0), ("p1", "2010-01-02", "glucose", 120.0),
             ("p2", "2010-01-01", "glucose", 90.0), ("p3", "2010-01-01", "hba1c", 5.0)],
    )


def test_tuples_counts_and_averages(spark):
    got = {(r.patient_id, r.feature): r.value for r in features.feature_tuples(small(spark)).collect()}
    assert got[("p1", "250.02")] == 2.0
    assert got[("p1", "glucose")] == 110.0
    assert got[("p1", "Lantus")] == 1.0
    assert got[("p3", "hba1c")] == 5.0


def test_same_name_two_domains_one_index_summed(spark):
    space = build_feature_space(features.feature_tuples(small(spark)))
    idx = {r.feature: r.idx for r in space.index.collect()}
    assert sorted(idx.values()) == list(range(len(idx)))  # 0..n-1, no gaps
    by_idx = [name for name, _ in sorted(idx.items(), key=lambda kv: kv[1])]
    assert by_idx == sorted(idx)  # numbered in name order
    long_form = {(r.patient_id, r.idx): r.value for r in space.matrix_long.collect()}
    assert long_form[("p2", idx["glucose"])] == 90.0 + 1.0  # lab average + drug count


def test_allow_list_case_sensitivity(spark):
    t = small(spark)
    assert features.medication_features(t.med, ["lantus"]).count() == 0
    assert features.medication_features(t.med, ["lantus"], case_insensitive=True).count() == 1
    terms = spark.createDataFrame([("Lantus",)], "term string")
    assert features.medication_features(t.med, terms).count() == 1


def test_filtered_tuples_subset(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    all_t = features.feature_tuples(t)
    filt = features.feature_tuples(t, SYNTHETIC_ALLOWED_CODES, SYNTHETIC_ALLOWED_DRUGS, SYNTHETIC_ALLOWED_LABS)
    assert filt.count() > 0
    assert filt.subtract(all_t).count() == 0
    lower_codes = [c.lower() for c in SYNTHETIC_ALLOWED_CODES]
    assert features.diagnostic_features(t.dx, lower_codes).count() == 0


def test_tuple_counts_sf0001(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    tuples = features.feature_tuples(t)
    assert tuples.count() == 4548
    assert tuples.select("patient_id").distinct().count() == 150
    assert features.feature_index(tuples).count() == 206


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_index_independent_of_partitions(spark, parts):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    idx = features.feature_index(features.feature_tuples(t), num_partitions=parts)
    rows = sorted((r.idx, r.feature) for r in idx.collect())
    assert [i for i, _ in rows] == list(range(206))
    assert [f for _, f in rows] == sorted(f for _, f in rows)


def test_moments_and_covariance_match_numpy(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    space = build_feature_space(features.feature_tuples(t))
    rows = sorted(space.vectors.collect(), key=lambda r: r.patient_id)
    n, x = len(rows), np.zeros((len(rows), space.n_features))
    for k, r in enumerate(rows):
        assert r.indices == sorted(set(r.indices))
        x[k, r.indices] = r["values"]
    mom = {r.idx: r for r in moments.feature_moments(space.matrix_long, n).collect()}
    mean, sd = x.mean(0), x.std(0, ddof=1)
    for i in range(space.n_features):
        assert mom[i].mean == pytest.approx(mean[i], abs=1e-9)
        assert mom[i].sd == pytest.approx(sd[i], abs=1e-7)
    m_df = moments.feature_moments(space.matrix_long, n)
    cov = moments.feature_covariance(space.vectors, m_df, n, space.n_features).collect()
    ok = sd > 0
    z = np.zeros_like(x)
    z[:, ok] = (x[:, ok] - mean[ok]) / sd[ok]
    expect = z.T @ z / (n - 1)
    assert len(cov) == space.n_features * (space.n_features + 1) // 2
    worst = max(abs(r.covariance - expect[r.i, r.j]) for r in cov)
    assert worst < 1e-9


def test_constant_feature_scales_to_zero(spark):
    t = tables(spark, dx=[("p1", "A", "2010-01-01"), ("p2", "A", "2010-01-01"), ("p2", "B", "2010-01-01")])
    space = build_feature_space(features.feature_tuples(t))
    mom = moments.feature_moments(space.matrix_long, 2)
    scaled = {(r.patient_id, r.idx): r.value for r in moments.scaled_long(space.matrix_long, mom, 2).collect()}
    assert scaled[("p1", 0)] == 0.0 and scaled[("p2", 0)] == 0.0


def test_salted_index_join_matches_broadcast(spark, monkeypatch):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    tuples = features.feature_tuples(t)
    index = features.feature_index(tuples)
    plain = sorted(tuple(r) for r in features.feature_matrix_long(tuples, index, 206).collect())
    monkeypatch.setattr(features, "BROADCAST_INDEX_MAX_ROWS", 10)
    salted_df = features.feature_matrix_long(tuples, index, 206, salt_buckets=4)
    assert "_salt" in salted_df._jdf.queryExecution().logical().toString()
    assert sorted(tuple(r) for r in salted_df.collect()) == plain


def test_label_stat_one_pass_equals_two_input_form(spark):
    from phenolens.operators import cohort, stats
    from phenolens.rules import SYNTHETIC_RULES
    t = synthetic_event_tables(spark, "/root/testdata/sf0.01")
    a = {r.label: (round(r.mean_value, 9), r.n_rows) for r in cohort.label_stat(t, SYNTHETIC_RULES).collect()}
    b = {r.label: (round(r.mean_value, 9), r.n_rows) for r in stats.lab_mean_by_label(
        t.lab, cohort.phenotype(t, SYNTHETIC_RULES), "purchase").collect()}
    assert a == b and a[2][1] == 723


def test_salted_paths_of_scaling_and_scoring(spark, monkeypatch):
    from phenolens.plans import clustering
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    space = build_feature_space(features.feature_tuples(t))
    n = space.matrix_long.select("patient_id").distinct().count()
    mom = moments.feature_moments(space.matrix_long, n)
    model, _ = clustering.fit_projection(space)
    plain_scaled = sorted(tuple(r) for r in moments.scaled_long(space.matrix_long, mom, space.n_features).collect())
    plain_scores = {r.patient_id: r.pca for r in clustering.score_long(model, space.matrix_long).collect()}
    monkeypatch.setattr(features, "BROADCAST_INDEX_MAX_ROWS", 10)
    salted_scaled = sorted(tuple(r) for r in moments.scaled_long(space.matrix_long, mom, space.n_features).collect())
    salted_scores = {r.patient_id: r.pca for r in clustering.score_long(model, space.matrix_long).collect()}
    assert salted_scaled == plain_scaled
    assert salted_scores.keys() == plain_scores.keys()
    assert all(np.allclose(salted_scores[p], plain_scores[p]) for p in plain_scores)


def test_vectors_add_repeated_indices_and_take_no_zero_room(spark):
    long = spark.createDataFrame([("b", 7, 1.0), ("a", 3, 2.0), ("a", 1, 5.0), ("a", 3, 0.5), ("c", 2_000_000, 1.0)],
                                 "patient_id string, idx int, value double")
    got = {r.patient_id: (r.indices, r["values"]) for r in features.patient_vectors(long).collect()}
    assert got == {"a": ([1, 3], [5.0, 2.5]), "b": ([7], [1.0]), "c": ([2_000_000], [1.0])}


def test_allow_list_of_a_table_filters_groups_not_events(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    terms = spark.createDataFrame([("RED PLATE",), ("cold gear",), ("nothing",)], "term string")
    late = features.medication_features(t.med, terms, case_insensitive=True)
    early = features.medication_features(t.med, ["red plate", "cold gear"])
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, early.collect())) != []
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Aggregate")  # the join stands above the grouping
    tagged = features.tagged_tuples(t)
    both = features.allowed_tuples(tagged, allow_drugs=["red plate"], allow_labs=["purchase"])
    assert {r.feature for r in both.collect()} == {"red plate", "purchase"}
