"""Near-duplicate detection by fast similarity sketches.

A document is the set of its distinct five-word shingles (64-bit hashes of
lower-cased words; fewer words make one shingle; no word, no shingle). The
sketch has ``COORDINATES`` places. In round r every shingle is thrown into one
place by a hash of (r, shingle) and leaves its value there if the place was
empty before the round or the value is smaller; after as many rounds as there
are places, round r fills place r - COORDINATES from all shingles. So every
place is filled after 2 * COORDINATES rounds at the latest, and a document of
many shingles needs one or two. Two sketches agree in a place with the
probability of the sets' Jaccard similarity, with the concentration of
independent samples.

``BANDS`` bands of ``ROWS`` places make bucket keys. Documents with equal sets
are one class first, so copies are never paired. In a bucket each member is
compared with the smallest one. Where a bucket then still holds several
components, its members are compared further, each with all members of other
components that can be linked with it at all: those with which it shares one
of its rarest shingles, by the exact filters of ``jaccard_join``. A passage
that thousands of documents have in common is frequent, so it makes no pairs of
them. Every link is confirmed on the full sets.

A pair at the threshold shares no bucket with probability
(1 - .75 ** ROWS) ** BANDS, 2e-5 with the defaults, less above it.

Cases: a null or blank text has no shingles, no links, and is its own
component. Rows that share a ``doc_id`` are versions of one document and share
a component; a null ``doc_id`` is linked with nothing (component null, kept).
Ties in a bucket go to the smallest id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix, renamed, scratch, written
from .jaccard_join import linked, set_batches
from .shingle_sets import MULT, connected_components, shingles

COORDINATES = 200
ROWS = 5
BANDS = COORDINATES // ROWS
PERCENT = 75


def sketches(at: np.ndarray, value: np.ndarray, rows: int, coordinates: int = COORDINATES) -> np.ndarray:
    """One fast similarity sketch for each row that has a value (others keep the fill value)."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(rows * coordinates, empty, np.uint64)
    t = np.uint64(coordinates)
    for r in range(2 * coordinates):
        if not len(value):
            break
        h = mix(value ^ mix(np.array([r + 1], np.uint64) * MULT[60]))
        own = (np.uint64(r) << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))
        place = ((h >> np.uint64(32)) * t >> np.uint64(32)).astype(np.int64) if r < coordinates else r - coordinates
        np.minimum.at(out, at * coordinates + place, own)
        if r < 8 or r % 8 == 0 or r >= coordinates:
            left = (out.reshape(rows, coordinates) == empty).any(1)[at]
            if not left.all():
                at, value = at[left], value[left]
    return out.reshape(rows, coordinates)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, t = sketch.shape
    parts = sketch[:, :t // rows * rows].reshape(n, t // rows, rows)
    key = (parts * MULT[:rows]).sum(2, dtype=np.uint64) + mix(np.arange(t // rows, dtype=np.uint64) + np.uint64(7))
    return mix(key).view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offs in chunks(batch.column("text")):
            at, value = shingles(data, offs)
            rows = hi - lo
            n = np.bincount(at, minlength=rows).astype(np.int64)
            h1, h2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            np.add.at(h1, at, mix(value))
            np.add.at(h2, at, mix(value ^ MULT[55]))
            keys = band_keys(sketches(at, value, rows))
            some = n > 0
            offsets = np.concatenate(([0], np.cumsum(np.where(some, keys.shape[1], 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, rows), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].ravel()))],
                names=["doc_id", "n_shingles", "h1", "h2", "bands"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of document ids those whose full sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify_batches, "a long, b long")


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, last_set = None, None
    for batch in batches:
        linked = []
        right = batch.column("text_b").to_pylist()
        left = [s for _, _, data, offs in chunks(batch.column("text_a"))
                for s in _sets(*shingles(data, offs), len(offs) - 1)]
        for a, b in zip(left, right, strict=True):
            if b != last:
                last = b
                (_, _, data, offs), = chunks(pa.array([b]))
                last_set = shingles(data, offs)[1]
            both = len(np.intersect1d(a, last_set, assume_unique=True))
            linked.append(both > 0 and 100 * both >= PERCENT * (len(a) + len(last_set) - both))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _sets(at: np.ndarray, value: np.ndarray, rows: int) -> list[np.ndarray]:
    return np.split(value, np.searchsorted(at, np.arange(1, rows)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    with scratch(docs.sparkSession) as keep:
        return keep(_judged(renamed(docs, {id_col: "doc_id", text_col: "text"})), "near_duplicates")


def _judged(docs: DataFrame) -> DataFrame:
    rows = written(docs.mapInArrow(
        _sketch_batches, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"), "sketches")
    classes = written(
        rows.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")), "classes")
    members = classes.select(F.explode("bands").alias("key"), F.struct("rep", F.col("n_shingles").alias("n")).alias("x"))
    crowded = members.groupBy("key").agg(F.min("x").alias("first"), F.max("x").alias("last")).where("first < last")
    buckets = written(members.join(crowded, "key").select(
        "key", F.col("x.rep").alias("rep"), F.col("x.n").alias("n"),
        F.col("first.rep").alias("center"), F.col("first.n").alias("center_n")), "buckets")
    texts = written(docs.join(buckets.select(F.col("rep").alias("doc_id")).distinct(), "doc_id"), "texts")

    alike = F.least("n", "center_n") * 100 >= F.greatest("n", "center_n") * PERCENT
    pairs = buckets.where((F.col("rep") != F.col("center")) & alike).select(
        F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    links = written(confirmed(pairs, texts), "links").distinct()
    component = connected_components(links)
    # Buckets that still hold several components: their members meet under the orders of the set join.
    tagged = buckets.select("key", "rep").join(component, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("c"))
    several = tagged.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    left = tagged.join(several, "key").select(F.col("rep").alias("doc_id")).distinct()
    sets = written(texts.join(left, "doc_id").mapInArrow(
        set_batches(PERCENT, False),
        "doc_id long, n long, cls long, tokens array<long>, order1 array<int>, order3 array<int>")
        .dropDuplicates(["cls"]), "open_sets")
    own = sets.select("doc_id", "cls")
    known = (links.join(own.withColumnsRenamed({"doc_id": "a", "cls": "ca"}), "a")
             .join(own.withColumnsRenamed({"doc_id": "b", "cls": "cb"}), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    grouped = written(own.join(linked(sets.drop("doc_id"), PERCENT, known), F.col("cls") == F.col("node")), "open_groups")
    first = grouped.groupBy("component").agg(F.min("doc_id").alias("a"))
    more = grouped.join(first, "component").where("a < doc_id").select("a", F.col("doc_id").alias("b"))
    if not more.isEmpty():
        component = connected_components(links.union(more))

    by_class = classes.join(component, classes.rep == component.node, "left").select(
        "n_shingles", "h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    some = rows.where("n_shingles > 0").join(by_class, ["n_shingles", "h1", "h2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    none = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.union(none).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
