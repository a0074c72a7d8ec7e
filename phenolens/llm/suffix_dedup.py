"""Removal of every byte that lies in a 100-byte string seen earlier.

A string of ``LENGTH`` bytes is repeated if it also starts at a smaller
(doc_id, start). Three steps find all repeated strings exactly once each:

1. *Anchors.* Every window of ``LENGTH`` bytes owns the ``ANCHOR``-byte piece
   with the smallest hash in it (the leftmost of equals). Equal windows own
   equal anchors at equal offsets, and neighbouring windows mostly share one:
   they form a segment. Only segments whose anchor occurs twice can repeat, so
   a count of anchor hashes leaves the unique part of the corpus behind before
   any text moves.
2. *Equal segments* are one segment with its first place; the others are
   removed whole.
3. *Column-wise construction.* The distinct segments of an anchor are laid one
   below the other, aligned at the anchor. From the last column to the first,
   each round inserts one symbol per segment: the order of the suffixes that
   start in the next column, read through the inserted symbols (the
   Burrows-Wheeler column of the round), gives by a stable sort the order of
   the suffixes that start here, and the common prefix of two neighbours is
   one more than the smallest one between their tails, or zero. Suffixes of
   different columns cannot share a window (the offset to the anchor is part
   of it), so a round keeps the entries of its own column alone: memory is that
   of one column and time is linear in the symbols. Runs of common prefixes of
   ``LENGTH`` are equal windows; all but the first place are removed.

The columns of a task are sequential passes over arrays in memory in place of
files: a collection is cut at about ``COLLECTION_BYTES`` between anchors. An
anchor with more than ``HOT_SEGMENTS`` distinct segments (a stock line in a
third of all documents) is cut into its windows instead, each a segment of its
own that step 2 settles by a map-side combined minimum, so no task holds it.

Cases: null and empty texts have no bytes; texts below ``LENGTH`` bytes lose
nothing. Rows that share a ``doc_id`` are told apart by a hash of the text,
equal rows are one document. A null ``doc_id`` sorts before all others. Long
texts are read in overlapping slices. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, mix, prefix_hash, renamed, versioned, written

LENGTH = 100
ANCHOR = 20
SPAN = LENGTH - ANCHOR + 1  # anchors in a window
HOT_SEGMENTS = 5000
COLLECTION_BYTES = 4 << 20
_BITS = np.uint64(24)
_INDEX = np.uint64((1 << 24) - 1)


def segments(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, number of windows, anchor's place, anchor hash, segment hash); places in ``data``."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < LENGTH:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    p, down = prefix_hash(data)
    anchor = mix((p[ANCHOR:] - p[:-ANCHOR]) * down[:n - ANCHOR + 1])
    low = (anchor >> _BITS << _BITS) | np.arange(len(anchor), dtype=np.uint64)
    span = 1
    while 2 * span <= SPAN:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if SPAN > span:
        low = np.minimum(low[:len(low) - (SPAN - span)], low[SPAN - span:])
    place = (low & _INDEX).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(place)]
    inside = offs[row + 1] - np.arange(len(place)) >= LENGTH
    window = np.flatnonzero(inside)
    if not len(window):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    own = place[window]
    new = np.ones(len(window), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[window][1:] != row[window][:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(window)))
    start = window[head]
    end = start + count + LENGTH - 1
    whole = mix((p[end] - p[start]) * down[start] + count.astype(np.uint64))
    return row[start], start, count, own[head], anchor[own[head]], whole


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, byte in the first row's text, bytes, offsets); long texts in overlapping parts."""
    for lo, _, data, offs in chunks(batch.column("text")):
        if len(offs) > 2 or len(data) <= 2 * CHUNK_BYTES:
            yield lo, 0, data, offs
        else:
            for at in range(0, len(data) - LENGTH + 1, CHUNK_BYTES):
                part = data[at:at + CHUNK_BYTES + LENGTH - 1]
                yield lo, at, part, np.array([0, len(part)])


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, at, data, offs in _slices(batch):
            row, start, count, place, h, g = segments(data, offs)
            take = pa.array(lo + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("version").take(take),
                 pa.array((start - offs[row] + at).astype(np.int32)), pa.array(count.astype(np.int16)),
                 pa.array((place - start).astype(np.int16)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64))],
                names=["doc_id", "version", "start", "windows", "lead", "h", "g"])


def _string_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their bytes, from texts with lists of segments."""
    names = ("start", "windows", "lead", "h", "g")
    for batch in batches:
        lists = batch.column("own")
        owner = pa.array(np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())))
        flat = lists.flatten()
        fields = [flat.field(k) for k in names]
        start, count = fields[0].to_numpy(), fields[1].to_numpy()
        raw = [x.encode() for x in batch.column("text").to_pylist()]
        strings = [raw[o][s:s + c + LENGTH - 1] for o, s, c in zip(owner.to_pylist(), start.tolist(), count.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(owner), batch.column("version").take(owner), *fields, pa.array(strings, pa.binary())],
            names=["doc_id", "version", *names, "bytes"])


def repeated_windows(group: np.ndarray, lead: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window in it) of the windows that an earlier segment of the group has too.

    Segments come sorted by group, then place. ``lead`` is the anchor's offset.
    """
    m, width = len(strings), 2 * LENGTH - ANCHOR
    size = np.array([len(s) for s in strings])
    left = (LENGTH - ANCHOR) - lead  # first column of each segment
    columns = np.zeros((width, m), np.int16)
    where = np.repeat(np.arange(m), size)
    column = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - left, size)
    columns[column, where] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
    order = np.arange(m)
    group = group.astype(np.int64)
    common = np.full(m + 1, LENGTH, np.int64)  # with the one before in the order
    common[:-1][np.append(True, group[1:] != group[:-1])] = 0
    found_segment, found_window = [], []
    for k in range(width - 1, -1, -1):
        symbol = columns[k, order]
        key = group[order] * 512 + symbol
        step = np.argsort(key, kind="stable")
        key = key[step]
        between = np.minimum.reduceat(common, step + 1)  # from one of a symbol to the next of it
        order = order[step]
        common[0] = 0
        common[1:m] = np.where(key[1:] == key[:-1], np.minimum(between[:-1] + 1, LENGTH), 0)
        if k <= LENGTH - ANCHOR:
            real = (left[order] <= k) & (k + LENGTH <= left[order] + size[order])
            head = np.flatnonzero(common[:m] < LENGTH)
            first = np.minimum.reduceat(order, head)
            again = real & (order != np.repeat(first, np.diff(np.append(head, m))))
            found_segment.append(order[again])
            found_window.append(k - left[order[again]])
    return np.concatenate(found_segment), np.concatenate(found_window)


def _column_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans to remove, from segments with bytes that come sorted by anchor and place."""
    kept: list[pa.RecordBatch] = []

    def settle(table: pa.Table) -> pa.RecordBatch:
        h = table.column("h").to_numpy()
        group = np.concatenate(([0], np.cumsum(h[1:] != h[:-1])))
        seg, win = repeated_windows(group, table.column("lead").to_numpy().astype(np.int64), table.column("bytes").to_pylist())
        order = np.lexsort((win, seg))
        seg, win = seg[order], win[order]
        new, last = np.ones(len(seg), bool), np.ones(len(seg), bool)  # both empty if no window repeats
        new[1:] = (seg[1:] != seg[:-1]) | (win[1:] != win[:-1] + 1)
        last[:-1] = new[1:]
        head, tail = np.flatnonzero(new), np.flatnonzero(last)
        start = table.column("start").to_numpy()[seg[head]] + win[head]
        end = table.column("start").to_numpy()[seg[head]] + win[tail] + LENGTH
        take = pa.array(seg[head])
        own = table.take(take).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [own.column(c).combine_chunks() if len(own) else pa.array([], pa.int64()) for c in ("doc_id", "version")]
            + [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["doc_id", "version", "start", "end"])

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        if sum(b.nbytes for b in kept) >= COLLECTION_BYTES:
            table = pa.Table.from_batches(kept)
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last anchor may go on in the next batch
            if cut:
                yield settle(table.slice(0, cut))
                kept = table.slice(cut).to_batches()
    if kept:
        yield settle(pa.Table.from_batches(kept))


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of segments with bytes: digest and start."""
    for batch in batches:
        strings = batch.column("bytes").to_pylist()
        owner, start, digest = [], [], []
        for i, (s, at) in enumerate(zip(strings, batch.column("start").to_pylist(), strict=True)):
            for k in range(len(s) - LENGTH + 1):
                owner.append(i)
                start.append(at + k)
                digest.append(hashlib.blake2b(s[k:k + LENGTH], digest_size=16).digest())
        take = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("version").take(take),
             pa.array(start, pa.int32()), pa.array(digest, pa.binary())], names=["doc_id", "version", "start", "digest"])


def repeated_spans(own: DataFrame) -> DataFrame:
    """doc_id, version, start, end (bytes) of repeated windows of (doc_id, version, text), partly overlapping."""
    place = F.struct("doc_id", "version", "start")
    every = own.mapInArrow(
        _segment_batches, "doc_id long, version long, start int, windows short, lead short, h long, g long")
    twice = every.groupBy("h").count().where("count > 1").select("h")
    likely = written(every.join(twice, "h"), "segments")
    distinct = likely.groupBy("h", "g").agg(
        F.min(F.struct("doc_id", "version", "start", "windows", "lead")).alias("f"), F.count("*").alias("n"))
    distinct = written(distinct.select("h", "g", "n", "f.*"), "distinct")
    first = distinct.where("n > 1").select("h", "g", place.alias("first"))
    copies = (likely.join(first, ["h", "g"]).where(~place.eqNullSafe(F.col("first")))
              .select("doc_id", "version", "start", (F.col("start") + F.col("windows") + (LENGTH - 1)).alias("end")))
    several = distinct.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = (distinct.join(several, "h").groupBy("doc_id", "version")
              .agg(F.collect_list(F.struct("start", "windows", "lead", "h", "g", "kinds")).alias("own")))
    strings = with_spans(own, wanted, "own").mapInArrow(
        _string_batches, "doc_id long, version long, start int, windows short, lead short, h long, g long, bytes binary")
    strings = written(strings.join(several, "h"), "strings")
    aligned = (strings.where(F.col("kinds") <= HOT_SEGMENTS).drop("kinds").repartition("h")
               .sortWithinPartitions("h", "doc_id", "version", "start")
               .mapInArrow(_column_batches, "doc_id long, version long, start int, end int"))
    windows = strings.where(F.col("kinds") > HOT_SEGMENTS).select("doc_id", "version", "start", "bytes").mapInArrow(
        _window_batches, "doc_id long, version long, start int, digest binary")
    again = windows.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    hot = (windows.join(again, "digest").where(~place.eqNullSafe(F.col("first")))
           .select("doc_id", "version", "start", (F.col("start") + LENGTH).alias("end")))
    return copies.union(aligned).union(hot)


def with_spans(own: DataFrame, spans: DataFrame, name: str, how: str = "inner") -> DataFrame:
    spans = spans.select(F.col("doc_id").alias("d"), F.col("version").alias("v"), name)
    joined = own.join(spans, own.doc_id.eqNullSafe(F.col("d")) & (own.version == F.col("v")), how)
    return joined.select("doc_id", "version", "text", name)


def merge_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal covered runs of the spans."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.append(0, np.flatnonzero(start[1:] > end[:-1]) + 1)
    tail = np.append(head[1:], len(start)) - 1
    return list(zip(start[head].tolist(), end[tail].tolist(), strict=True))


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
            raw, runs = (text or "").encode(), []
            if spans.is_valid:
                flat = spans.values
                runs = merge_spans(flat.field("start").to_numpy(), flat.field("end").to_numpy())
            kept, at = [], 0
            for start, end in runs:
                kept.append(raw[at:start])
                at = end
            kept.append(raw[at:])
            out.append((len(raw), sum(e - s for s, e in runs), len(runs), b"".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([x[k] for x in out], t) for k, t in
                                       enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) of every row."""
    own = versioned(renamed(docs, {id_col: "doc_id", text_col: "text"}))
    spans = (repeated_spans(own).groupBy("doc_id", "version")
             .agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    return with_spans(own, spans, "spans", "left").mapInArrow(
        _kept_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
