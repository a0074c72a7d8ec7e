"""Word shingles of texts, and the components that links between documents make."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix, word_hashes, word_spans, written

SHINGLE_WORDS = 5

MULT = mix(np.arange(1, 64, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def shingles(data: np.ndarray, offs: np.ndarray, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, sorted by row and hash."""
    data = LOWER[data]
    start, end, row = word_spans(data, offs)
    h = word_hashes(data, start, end)
    rows = len(offs) - 1
    first = np.searchsorted(row, np.arange(rows))
    last = np.searchsorted(row, np.arange(rows), "right")
    count = last - first
    full = np.zeros(0, np.uint64)
    at = np.zeros(0, np.int64)
    if len(h) >= words:
        full = sum(h[j:len(h) - words + 1 + j] * MULT[j] for j in range(words))
        ok = row[:len(full)] == row[words - 1:]
        full, at = mix(full[ok]), row[:len(ok)][ok]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        few = np.array([(h[first[i]:last[i]] * MULT[:count[i]]).sum(dtype=np.uint64) for i in short], np.uint64)
        few += MULT[50] * count[short].astype(np.uint64)
        full, at = np.concatenate((full, mix(few))), np.concatenate((at, short))
    order = np.lexsort((full, at))
    full, at = full[order], at[order]
    if len(full):
        new = np.ones(len(full), bool)
        new[1:] = (full[1:] != full[:-1]) | (at[1:] != at[:-1])
        full, at = full[new], at[new]
    return at, full


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node it reaches.

    Smallest labels spread along the edges and are then looked up through
    themselves, which halves the distance to the root each round.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        heard = (both.join(label, both.b == label.node).groupBy("a").agg(F.min("component").alias("m")))
        near = (label.join(heard, label.node == heard.a)
                .select("node", F.col("component").alias("old"), F.least("component", "m").alias("component")))
        root = label.select(F.col("node").alias("r"), F.col("component").alias("root"))
        step = written(near.join(root, near.component == root.r)
                       .select("node", "old", F.least("component", "root").alias("component")), "labels")
        label = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return label
