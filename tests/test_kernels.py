"""Property tests of the NumPy kernels that run inside Spark tasks."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from phenolens.operators.moments import _gram_partials, _sum_blocks

N = 7
patient = st.dictionaries(st.integers(0, N - 1), st.floats(-100, 100, allow_nan=False), max_size=N)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(patient, max_size=6), max_size=4), st.lists(st.floats(-10, 10), min_size=N, max_size=N), st.integers(1, 9))
def test_gram_partials_sum_to_the_centred_product(batches, center, block):
    frames = [pa.RecordBatch.from_arrays(
        [pa.array([list(r) for r in b], pa.list_(pa.int32())), pa.array([list(r.values()) for r in b], pa.list_(pa.float64()))],
        names=["indices", "values"]) for b in batches]
    out = list(_gram_partials(N, np.array(center), block)(iter(frames)))
    rows = [r for b in batches for r in b]
    if not rows:
        assert out == []
        return
    x = np.array([[r.get(i, 0.0) for i in range(N)] for r in rows]) - center
    g = x.T @ x
    for batch in out:
        (r,) = batch.to_pylist()
        i, j = r["bi"], r["bj"]
        assert i <= j and np.allclose(np.reshape(r["cells"], g[i:i + block, j:j + block].shape), g[i:i + block, j:j + block])


def test_blocks_of_a_group_are_added():
    group = pa.table({"bi": [0, 0], "bj": [2, 2], "cells": [[1.0, 2.0], [10.0, 20.0]]})
    assert _sum_blocks(["bi", "bj"])(group).to_pylist() == [{"bi": 0, "bj": 2, "cells": [11.0, 22.0]}]
