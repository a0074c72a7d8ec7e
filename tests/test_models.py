"""Scaler + PCA + clusterers on the sf0.001 feature space (rows-only style checks)."""

import threading

import numpy as np
import pytest

from phenolens.operators import cohort, features, moments
from phenolens.plans import clustering, given, saved_model, subspace
from phenolens.rules import (
    SYNTHETIC_ALLOWED_CODES,
    SYNTHETIC_ALLOWED_DRUGS,
    SYNTHETIC_ALLOWED_LABS,
    SYNTHETIC_RULES,
)
from phenolens.sources import synthetic_event_tables
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def space(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    return t, clustering.build_feature_space(features.feature_tuples(t))


def test_projection_shape_and_variance_order(spark, space):
    _, sp = space
    _, proj = clustering.fit_projection(sp)
    arr = np.array([r.p for r in proj.select(vector_to_array("pca").alias("p")).collect()])
    assert arr.shape == (150, 10)
    assert np.allclose(arr.mean(0), 0, atol=1e-8)
    var = arr.var(0)
    assert all(var[i] >= var[i + 1] - 1e-9 for i in range(9))


def test_clusterers(spark, space):
    _, sp = space
    _, proj = clustering.fit_projection(sp)
    for fn in (clustering.kmeans_clusters, clustering.gmm_clusters, clustering.streaming_kmeans_clusters):
        out = fn(proj)
        assert out.count() == 150
        assert {r.cluster for r in out.select("cluster").distinct().collect()} <= {0, 1, 2}
    a = sorted(tuple(r) for r in clustering.kmeans_clusters(proj).collect())
    b = sorted(tuple(r) for r in clustering.kmeans_clusters(proj).collect())
    assert a == b  # fixed seed, fixed layout


def test_pca_needs_ten_features(spark):
    tuples = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 2.0), ("c", "y", 1.0)],
                                   "patient_id string, feature string, value double")
    small = clustering.build_feature_space(tuples)
    with pytest.raises(ValueError):
        clustering.fit_projection(small)
    _, proj = clustering.fit_projection(small, clip_k=True)
    assert proj.count() == 3


def test_purity_report(spark, space):
    t, sp = space
    labels = cohort.phenotype(t, SYNTHETIC_RULES)
    rep = clustering.evaluate(labels, sp, "all").collect()
    assert [r.algorithm for r in rep] == ["kmeans", "gmm", "streaming_kmeans"]
    for r in rep:
        assert r.n_pairs == 148 and 1 / 3 <= r.purity <= 1


def test_purity_report_runs_its_fits_side_by_side(spark, space, monkeypatch):
    t, _ = space
    meet, labels_written = threading.Barrier(2, timeout=120), []
    inner, write = clustering.gmm_clusters, clustering.materialize_table

    def gmm_of_both_arms(projection):
        meet.wait()  # breaks unless both arms get here at once
        return inner(projection)

    def recorded(df, label):
        labels_written.append(label)
        return write(df, label)

    monkeypatch.setattr(clustering, "gmm_clusters", gmm_of_both_arms)
    monkeypatch.setattr(clustering, "materialize_table", recorded)
    rep = clustering.purity_report(
        cohort.phenotype(t, SYNTHETIC_RULES), features.tagged_tuples(t), allow_codes=SYNTHETIC_ALLOWED_CODES,
        allow_drugs=SYNTHETIC_ALLOWED_DRUGS, allow_labs=SYNTHETIC_ALLOWED_LABS).collect()
    assert [(r.feature_set, r.algorithm) for r in rep] == [
        (arm, fit) for arm in ("all", "filtered") for fit in ("kmeans", "gmm", "streaming_kmeans")]
    assert all(0 < r.purity <= 1 for r in rep)
    assert labels_written.count("tagged-tuples") == 1 and "feature-tuples" not in labels_written


@pytest.fixture(scope="module")
def ml_scores(space):
    _, sp = space
    model = clustering.fit_pipeline(sp)
    return model, {r.patient_id: r.p for r in clustering.score(model, sp.vectors, sp.n_features).select(
        "patient_id", vector_to_array("pca").alias("p")).collect()}


def test_ml_vectors_are_sparse_and_equal_the_arrays(spark, space):
    _, sp = space
    stored = features.as_ml_vectors(sp.vectors, sp.n_features)
    arrays = {r.patient_id: (r.indices, r["values"]) for r in sp.vectors.collect()}
    for r in stored.collect():
        assert r.features.size == sp.n_features and type(r.features).__name__ == "SparseVector"
        assert (r.features.indices.tolist(), r.features.values.tolist()) == arrays[r.patient_id]


def test_score_long_equals_the_pipeline(space, ml_scores):
    _, sp = space
    model, dense = ml_scores
    sparse = {r.patient_id: r.pca for r in clustering.score_long(model, sp.matrix_long).collect()}
    assert dense.keys() == sparse.keys()
    assert all(np.allclose(sparse[pid], vec, atol=1e-9) for pid, vec in dense.items())


def test_long_form_pca_matches_ml_up_to_sign(space, ml_scores):
    _, sp = space
    model, dense = ml_scores
    ml = clustering.LinearProjection.from_pipeline(model)
    ours = clustering.fit_pca_long(sp)
    assert np.allclose(ours.mean, ml.mean) and np.allclose(ours.std, ml.std)
    assert np.allclose(ours.explained_variance, ml.explained_variance, atol=1e-9)
    for d in range(10):
        a, b = ours.pc[:, d], ml.pc[:, d]
        assert np.allclose(a, b, atol=1e-6) or np.allclose(a, -b, atol=1e-6)
    scores = {r.patient_id: np.abs(r.pca) for r in clustering.score_long(ours, sp.matrix_long).collect()}
    assert all(np.allclose(scores[p], np.abs(dense[p]), atol=1e-6) for p in dense)


def low_rank(spark, n=60, features_=24, rank=3, seed=2):
    """Sparse rows with three strong directions, one constant and one missing feature."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, rank)) @ rng.standard_normal((rank, features_)) * 3 + rng.standard_normal((n, features_)) * 0.05
    x[rng.random(x.shape) < 0.02] = 0.0
    x[:, 4] = 7.0
    rows = [(f"p{i:03d}", j, float(x[i, j])) for i in range(n) for j in range(features_) if x[i, j] != 0]
    return x, spark.createDataFrame(rows, "patient_id string, idx int, value double")


def test_subspace_iteration_equals_the_exact_components(spark, monkeypatch):
    x, long = low_rank(spark)
    n, k = x.shape[0], 3
    mom = moments.feature_moments(long, n).cache()
    model = subspace.fit_subspace(long, mom, n, x.shape[1], k, oversample=4)
    sd = x.std(0, ddof=1)
    z = np.divide(x - x.mean(0), sd, out=np.zeros_like(x), where=sd > 1e-9)
    values, vectors = np.linalg.eigh(z.T @ z / (n - 1))
    exact = vectors[:, ::-1][:, :k]
    # The same subspace: both projectors agree, and so do the single components up to sign.
    assert np.abs(model.pc @ model.pc.T - exact @ exact.T).max() < 1e-6
    assert np.abs(np.abs((model.pc * exact).sum(0)) - 1).max() < 1e-6
    assert np.allclose(model.explained_variance, values[::-1][:k] / (x.shape[1] - 1), atol=1e-7)
    # Above the bound fit_pca_long goes this way.
    called = []
    monkeypatch.setattr(clustering, "DRIVER_FEATURES", 1)
    monkeypatch.setattr(clustering, "fit_subspace", lambda *a: called.append(a[3:]) or model)
    vectors_ = features.patient_vectors(long)
    assert clustering.fit_pca_long(clustering.FeatureSpace(None, long, vectors_, x.shape[1]), k) is model and called == [(24, 3)]


def test_kmeans_from_given_centres_equals_numpy(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((40, 3)) + c for c in ((0, 0, 0), (6, 0, 0), (0, 9, 0))])
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, features array<double>")
    start = [[0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [500.0, 0.0, 0.0]]  # the last one never gets a point
    model = given.kmeans_from(points, start, iterations=5, tolerance=0.0)
    c = np.array(start)
    for _ in range(5):
        near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.array([x[near == k].mean(0) if (near == k).any() else c[k] for k in range(3)])
    assert np.allclose(model.centres, c) and model.sizes == [float((near == k).sum()) for k in range(3)]
    assert model.centres[2] == start[2] and model.iterations <= 5
    got = {r.vec_id: r.cluster for r in model.predict(points).collect()}
    assert [got[i] for i in range(len(x))] == ((x[:, None] - c) ** 2).sum(2).argmin(1).tolist()


def test_mixture_fit_equals_a_numpy_replay(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.multivariate_normal(m, s, 60) for m, s in (
        ((1e4, 0), ((1, .6), (.6, 1))), ((1e4 + 5, 3), ((.5, 0), (0, 2))))])
    points = spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>").repartition(5)
    start = given.Mixture.around([[1e4 - 1, 0.5], [1e4 + 4, 2.0]])
    model, track = given.fit_mixture(points, start, iterations=6, tolerance=-1.0)
    w, mean, cov, likelihoods = start.weights, start.means, start.covariances, []
    for _ in range(6):
        logs = np.stack([np.log(w[k]) - ((x - mean[k]) @ np.linalg.inv(cov[k]) * (x - mean[k])).sum(1) / 2
                         - np.log(np.linalg.det(cov[k])) / 2 - np.log(2 * np.pi) for k in range(2)], 1)
        total = np.logaddexp.reduce(logs, 1)
        likelihoods.append(total.mean())
        r = np.exp(logs - total[:, None])
        w, mean = r.mean(0), (r.T @ x) / r.sum(0)[:, None]
        cov = np.stack([((r[:, k, None] * (x - mean[k])).T @ (x - mean[k])) / r[:, k].sum() + given.RIDGE * np.eye(2) for k in range(2)])
    assert np.allclose(track, likelihoods, atol=1e-8) and all(b >= a - 1e-9 for a, b in zip(track, track[1:], strict=False))
    assert np.allclose(model.weights, w) and np.allclose(model.means, mean) and np.allclose(model.covariances, cov, atol=1e-7)
    got = given.predict_mixture(points, model).select("cluster").collect()
    assert sorted(g.cluster for g in got) == sorted(model.log_densities(x).argmax(1).tolist())
    with pytest.raises(ValueError):
        given.em_step(points.limit(0), start)


def test_saved_model_scores_like_the_model_it_was(spark, space, tmpdir_fresh):
    _, sp = space
    model = clustering.fit_pca_long(sp)
    path = f"{tmpdir_fresh}/model"
    assert saved_model.versions(spark, path) == []
    assert saved_model.save_model(model, sp.index, path) == 1
    other = clustering.LinearProjection(model.mean * 0, model.std, model.pc)
    assert saved_model.save_model(other, sp.index, path) == 2 and saved_model.versions(spark, path) == [1, 2]
    tuples = sp.matrix_long.join(sp.index, "idx").select("patient_id", "feature", "value")
    unseen = spark.createDataFrame([("new", "no such name", 5.0), ("both", "no such name", 1.0)], tuples.schema)
    known = tuples.where("patient_id = '1'").withColumn("patient_id", F.lit("both"))
    direct = {r.patient_id: r.pca for r in clustering.score_long(model, sp.matrix_long).collect()}
    loaded = saved_model.load_model(spark, path, 1)
    got = {r.patient_id: r.pca for r in saved_model.score_new(loaded, tuples.union(unseen).union(known)).collect()}
    assert got.keys() == direct.keys() | ({"both"} if "1" in direct else set())
    assert all(np.allclose(got[p], direct[p], atol=1e-9) for p in direct)
    if "1" in direct:
        assert np.allclose(got["both"], direct["1"], atol=1e-9)
    assert saved_model.load_model(spark, path).agg(F.max("mean")).first()[0] == 0.0  # the newest
    with pytest.raises(ValueError):
        saved_model.load_model(spark, path, 9)
