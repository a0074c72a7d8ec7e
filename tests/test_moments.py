"""Moments and covariance must not cancel; the Gram blocks must add up."""

import math

import numpy as np
import pytest

from phenolens.operators import moments


def _frames(spark, columns):
    long, vectors = [], []
    n = len(columns[0])
    for k in range(n):
        row = [c[k] for c in columns]
        vectors.append((f"p{k:04d}", [i for i, v in enumerate(row) if v], [v for v in row if v]))
        long += [(f"p{k:04d}", i, v) for i, v in enumerate(row) if v != 0.0]
    return (spark.createDataFrame(long, "patient_id string, idx int, value double"),
            spark.createDataFrame(vectors, "patient_id string, indices array<int>, values array<double>"))


def test_large_values_keep_their_variance(spark):
    n = 200
    columns = [[123456.789] * n, [1e8 + k % 2 for k in range(n)], [float(k % 3 == 0) for k in range(n)]]
    long, vectors = _frames(spark, columns)
    m = moments.feature_moments(long, n).cache()
    rows = {r.idx: r for r in m.collect()}
    assert rows[0].sd == 0.0 and rows[0].zero_value == 0.0
    assert rows[1].sd == pytest.approx(math.sqrt(0.25 * n / (n - 1)), rel=1e-6)
    mean = sum(columns[2]) / n
    assert rows[2].sd == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in columns[2]) / (n - 1)), rel=1e-12)
    cov = {(r.i, r.j): r.covariance for r in moments.feature_covariance(vectors, m, n, 3).collect()}
    assert cov[0, 0] == 0.0 and cov[1, 1] == pytest.approx(1.0, abs=1e-6) and cov[2, 2] == pytest.approx(1.0, abs=1e-6)


def test_one_patient_has_no_spread(spark):
    long, _ = _frames(spark, [[5.0], [7.0]])
    assert [(r.mean, r.sd, r.zero_value) for r in moments.feature_moments(long, 1).orderBy("idx").collect()] == [
        (5.0, 0.0, 0.0), (7.0, 0.0, 0.0)]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 50])
def test_gram_blocks_are_the_upper_triangle(spark, block):
    rng = np.random.default_rng(block)
    x = rng.standard_normal((23, 7)) * (rng.random((23, 7)) < 0.5)
    center = rng.standard_normal(7)
    _, vectors = _frames(spark, x.T.tolist())
    vectors = vectors.repartition(6)
    expect = (x - center).T @ (x - center)
    blocks = moments.gram_blocks(vectors, 7, center, block=block, shares=2)
    places = [(r.bi, r.bj) for r in blocks.collect()]
    assert sorted(places) == moments.block_starts(7, block)
    assert np.allclose(moments.matrix_of(blocks, 7, block), expect)
    cells = {(r.i, r.j): r.s for r in moments.gram_long(blocks, 7, block).collect()}
    assert len(cells) == 28 and all(i <= j and np.isclose(s, expect[i, j]) for (i, j), s in cells.items())


def test_gram_of_no_rows_is_empty(spark):
    _, vectors = _frames(spark, [[1.0], [2.0]])
    assert moments.gram_blocks(vectors.where("false"), 2).count() == 0
    assert moments.matrix_of(moments.gram_blocks(vectors.where("false"), 2), 2).tolist() == [[0, 0], [0, 0]]
