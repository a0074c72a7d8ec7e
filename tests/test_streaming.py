"""Mini-batch k-means: update rule against NumPy, dying clusters, foreachBatch."""

import os

import numpy as np
import pytest

from phenolens.streaming import kmeans as skm
from pyspark.sql import functions as F


def numpy_update(x, centres, weights, decay, unit):
    c, w = centres.copy(), weights.copy()
    d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
    a = d.argmin(1)
    discount = decay if unit == "batches" else decay ** len(x)
    w = w * discount
    for k in range(len(c)):
        m = (a == k).sum()
        if m == 0:
            continue
        s = x[a == k].sum(0)
        new_w = w[k] + m
        lam = m / max(new_w, 1e-16)
        c[k] = (1 - lam) * c[k] + lam / m * s
        w[k] = new_w
    lo, hi = int(np.argmin(w)), int(np.argmax(w))
    if w[lo] < 1e-8 * w[hi]:
        nw = (w[lo] + w[hi]) / 2
        w[lo] = w[hi] = nw
        base = c[hi].copy()
        p = 1e-14 * np.maximum(np.abs(base), 1.0)
        c[hi], c[lo] = base + p, base - p
    return c, w


def points_df(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                                 "id int, features array<double>")


@pytest.mark.parametrize("decay,unit", [(1.0, "points"), (0.5, "batches"), (0.9, "points")])
def test_update_matches_numpy(spark, decay, unit):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(loc, 0.3, size=(60, 4)) for loc in (-2.0, 0.0, 2.0)])
    c0 = rng.normal(0, 1, size=(3, 4))
    w0 = np.array([0.5, 2.0, 1.0])
    centres = skm.centres_frame(spark, c0.tolist(), w0.tolist())
    new = skm.update(points_df(spark, x), centres, decay, unit).orderBy("cluster").collect()
    c, w = numpy_update(x, c0, w0, decay, unit)
    assert [r.weight for r in new] == pytest.approx(list(w))
    for r in new:
        assert r.center == pytest.approx(list(c[r.cluster]), abs=1e-12)


def test_decay_one_weights_sum(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    centres = skm.random_centres(spark, 3, 3, 0.5, 6250)
    new = skm.update(points_df(spark, x), centres, 1.0, "points")
    assert new.agg(F.sum("weight")).first()[0] == pytest.approx(201.5)


def test_dying_cluster_split(spark):
    x = np.array([[10.0, 10.0]] * 5)
    c0 = np.array([[10.0, 10.0], [-50.0, -50.0]])
    w0 = np.array([1e9, 1e-3])
    centres = skm.centres_frame(spark, c0.tolist(), w0.tolist())
    new = skm.update(points_df(spark, x), centres, 1.0, "batches").orderBy("cluster").collect()
    c, w = numpy_update(x, c0, w0, 1.0, "batches")
    assert new[0].weight == pytest.approx(w[0]) and new[1].weight == pytest.approx(w[1])
    assert new[0].center == list(c[0]) and new[1].center == list(c[1])
    assert new[1].center[0] < new[0].center[0]


def test_foreach_batch_stream(spark, tmpdir_fresh):
    """Structured Streaming over parquet files; one update per micro-batch."""
    rng = np.random.default_rng(3)
    src = os.path.join(tmpdir_fresh, "in")
    batches = [rng.normal(size=(40, 2)) + off for off in (0.0, 3.0)]
    for b, x in enumerate(batches):
        points_df(spark, x).coalesce(1).write.parquet(os.path.join(src, f"part={b}"))
    c0 = np.array([[0.0, 0.0], [3.0, 3.0]])
    model = skm.StreamingKMeans(os.path.join(tmpdir_fresh, "state"),
                                skm.centres_frame(spark, c0.tolist(), 1.0), decay=0.5, time_unit="batches")
    stream = (spark.readStream.schema("id int, features array<double>, part int")
              .option("maxFilesPerTrigger", 1).parquet(src))
    query = (stream.writeStream.foreachBatch(model.process_batch)
             .option("checkpointLocation", os.path.join(tmpdir_fresh, "ckpt"))
             .trigger(availableNow=True).start())
    query.awaitTermination(300)
    n_batches = spark.read.parquet(os.path.join(tmpdir_fresh, "state")).select("batch").distinct().count()
    assert n_batches == 3  # initial state + two micro-batches
    # Same result as two static updates in file order.
    c, w = c0, np.array([1.0, 1.0])
    for x in batches:
        c, w = numpy_update(x, c, w, 0.5, "batches")
    final = model.latest(spark).orderBy("cluster").collect()
    assert [r.weight for r in final] == pytest.approx(list(w))
    assert model.predict(points_df(spark, batches[1])).select("cluster").distinct().count() >= 1


def test_replayed_batch_writes_same_state(spark, tmpdir_fresh):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(50, 2))
    model = skm.StreamingKMeans(os.path.join(tmpdir_fresh, "state"),
                                skm.centres_frame(spark, [[0.0, 0.0], [1.0, 1.0]], 1.0))
    batch = points_df(spark, x)
    model.process_batch(batch, 0)
    first = sorted((r.cluster, r.weight, tuple(r.center)) for r in model.latest(spark).collect())
    model.process_batch(batch, 0)  # replay after a failure
    again = sorted((r.cluster, r.weight, tuple(r.center)) for r in model.latest(spark).collect())
    assert first == again
    state = spark.read.parquet(os.path.join(tmpdir_fresh, "state"))
    assert state.where("batch = 0").count() == 2


def _points(spark, n, dim, seed=3):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(i, rng.standard_normal(dim).tolist()) for i in range(n)], "id int, features array<double>")


def test_many_centres_are_measured_as_one_block(spark):
    dim = 64
    points = _points(spark, 2000, dim)
    centres = np.random.default_rng(5).standard_normal((500, dim))
    got = skm.assign(points, skm.centres_frame(spark, centres.tolist(), 1.0)).collect()
    for r in got[::97]:
        assert r.cluster == ((np.array(r.features) - centres) ** 2).sum(1).argmin()
    out = skm.update(points, skm.centres_frame(spark, centres.tolist(), 1.0)).orderBy("cluster").collect()
    want, weights = numpy_update(np.array([r.features for r in got]), centres, np.ones(500), 1.0, "batches")
    np.testing.assert_allclose([r.center for r in out], want, atol=1e-9)
    assert [r.weight for r in out] == weights.tolist()


def test_plan_does_not_grow_with_the_number_of_centres(spark):
    points = _points(spark, 10, 64)

    def size(k):
        plan = skm.assign(points, skm.centres_frame(spark, np.zeros((k, 64)).tolist(), 1.0))
        return len(plan._jdf.queryExecution().executedPlan().toString())

    assert abs(size(50) - size(500)) < 20


def test_block_and_literals_give_the_same_bits(spark, monkeypatch):
    points = _points(spark, 500, 5).unionByName(spark.createDataFrame(
        [(-1, None), (-2, [1.0, None, 0.0, 0.0, 0.0]), (-3, [1.0]), (-4, [0.0] * 5), (-5, [float("nan")] * 5)],
        "id int, features array<double>"))
    centres = np.random.default_rng(1).standard_normal((6, 5)).tolist()
    centres[3] = centres[1]  # a tie: the smaller id has it
    frame = skm.centres_frame(spark, centres, 1.0)
    literal = {r.id: r.cluster for r in skm.assign(points, frame).collect()}
    monkeypatch.setattr(skm, "LITERAL_VALUES", 0)
    block = {r.id: r.cluster for r in skm.assign(points, frame).collect()}
    assert block == literal and [block[i] for i in (-1, -2, -3)] == [None] * 3 and 3 not in block.values()


def test_state_folder_holds_the_first_and_two_states(spark, tmpdir_fresh):
    state = os.path.join(tmpdir_fresh, "rotating")
    model = skm.StreamingKMeans(state, skm.centres_frame(spark, [[0.0, 0.0], [5.0, 5.0]], 0.0))
    batches = [spark.createDataFrame([([float(b), 1.0],), ([6.0, 5.0 + b],)], "features array<double>") for b in range(5)]
    for b, batch in enumerate(batches):
        model.process_batch(batch, b)
    assert sorted(f for f in os.listdir(state) if f.startswith("batch=")) == ["batch=-1", "batch=3", "batch=4"]
    before = model.latest(spark).orderBy("cluster").collect()
    model.process_batch(batches[4], 4)  # a batch replayed starts from the same state
    assert model.latest(spark).orderBy("cluster").collect() == before
