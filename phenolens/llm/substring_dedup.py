"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: ``h = (h << 1) + gear[byte]`` over
the last ``WINDOW`` bytes. A chunk ends, at the start of a code point, where
the hash is the smallest among some ``SPREAD`` neighbouring places, whatever
the script or the spacing. That depends on the bytes within ``SPREAD`` and
``WINDOW`` of the place alone, so an insertion moves the chunks near it only,
and a passage of ``2 * SPREAD + WINDOW`` bytes or more has a whole chunk in
common wherever it stands. A chunk has about ``SPREAD / 2`` bytes and at most
``SPREAD``; only where a text repeats itself every few bytes (a ruled line)
are equal hashes passed over, up to ``MAX_BYTES``, and cuts counted from the
start of such a stretch. Chunk hashes of 8 bytes are counted first, combined in
each task, and marked in a bit table of fixed size if they occur twice; only
chunks with a mark, a small part, go on. They are deduplicated by a 128-bit
digest: the occurrence with the smallest (doc_id, start) stays. A run of
neighbouring repeated chunks is extended byte by byte, by up to ``REACH`` bytes
on either side, as far as the text equals that around the first occurrence of
the run's outermost chunk or the one next to it (a chunk carries hashes of the ``SIDE``
bytes on either side, so that short runs that cannot grow long enough need no bytes fetched); so a repeated passage goes as a whole, not only
its whole chunks. Extended runs of ``RUN_BYTES`` or more are cut out of the
text, but for the parts of words at their ends and one space in front; shorter
ones (a stock phrase) stay. Over 50 words of two letters or more on average
(or over 50 Chinese characters) are long enough to have a whole chunk in common.

Cases: null and empty texts have no chunks and stay as they are. Rows that
share a ``doc_id`` are told apart by a hash of the text; equal rows are one
document, so they keep or lose the same bytes. A null ``doc_id`` sorts before
all others. Other columns stay, whatever they are called. Runs are extended
along the first occurrence of their outermost chunks only. An empty table gives an empty result. Text is processed whole;
memory follows the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, chunks, mix, prefix_hash, scratch, versioned, written

WINDOW = 16
SPREAD = 64
MAX_BYTES = 256
RUN_BYTES = 100
REACH = 256
#: Bytes on either side of a chunk whose hash it carries: an end that differs there is extended by less.
SIDE = 16
#: Chunk hashes that a task combines at a time, and bits of the table of repeated ones (16 MB).
HELD, MARK_BITS = 1 << 20, 1 << 27
#: Text bytes, and repeated chunks, that a task takes from a batch at a time: Python objects are made of no more.
SLICE_BYTES, SLICE_SPANS = 1 << 18, 1 << 13
#: Of a word cut by the end of a run, at most so many bytes are given back.
WORD_BYTES = 24

GEAR = mix(np.arange(1, 257, dtype=np.uint64))


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Rolling hash of the last ``WINDOW`` bytes at every byte (by doubling the window)."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint64(span)
        h, span = longer, 2 * span
    return h


def _running(best, x: np.ndarray, span: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``span`` neighbours."""
    size = 1
    while 2 * size <= span:
        x, size = best(x[:-size], x[size:]), 2 * size
    return best(x[:size - span], x[span - size:]) if size < span else x


def boundaries(data: np.ndarray) -> list[int]:
    """Ends of the chunks of one text's bytes, the last being its length."""
    n = len(data)
    if n < SPREAD:
        return [n] if n else []
    h = gear_hash(data)
    never = np.uint64(2 ** 64 - 1)
    h[:-1][data[1:] & 0xC0 == 0x80] = never
    least = np.pad(_running(np.minimum, h, SPREAD), SPREAD - 1)
    ends = np.flatnonzero((h == _running(np.maximum, least, SPREAD)) & (h != never)) + 1
    same = np.zeros(len(ends), bool)
    same[1:] = (h[ends[1:] - 1] == h[ends[:-1] - 1]) & (np.diff(ends) < SPREAD)
    ends, same = ends.tolist(), same.tolist()
    if any(same):
        out, start = [], 0
        for k, end in enumerate(ends):
            after = ends[k + 1] if k + 1 < len(ends) else n
            if not same[k] or after - start > MAX_BYTES:
                out.append(end)
                start = end
        ends = out
    return ends if ends and ends[-1] == n else [*ends, n]


def pieces(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every chunk of the texts that lie one behind the other, start and end within the whole."""
    ends = [boundaries(data[lo:hi]) for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    count = np.array([len(e) for e in ends], np.int64)
    row = np.repeat(np.arange(len(ends)), count)
    end = np.concatenate([np.asarray(e, np.int64) for e in ends]) if len(row) else np.zeros(0, np.int64)
    end = end + offs[row]
    start = np.concatenate(([0], end[:-1])) if len(row) else end
    return row, np.maximum(start, offs[row]), end


def chunk_hashes(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [start, end), from the ``prefix_hash`` of the whole."""
    p, down = sums
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n): the chunk hashes of a task, combined ``HELD`` at a time."""
    held: list[np.ndarray] = []

    def flushed() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    for batch in batches:
        for _, _, data, offs in chunks(batch.column("text"), SLICE_BYTES):
            _, start, end = pieces(data, offs)
            held.append(chunk_hashes(prefix_hash(data), start, end))
            if sum(map(len, held)) >= HELD:
                yield flushed()
    if held:
        yield flushed()


def repeated_marks(own: DataFrame) -> np.ndarray:
    """A bit for each chunk hash that occurs twice or more, at the place of its lowest bits.

    The table has ``MARK_BITS`` bits whatever the input; a chunk that shares its bit with a repeated
    one goes on for nothing, which costs time and changes no result.
    """
    twice = own.mapInArrow(_count_batches, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    place = F.col("h").bitwiseAND(F.lit(MARK_BITS - 1))
    words = twice.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(h & {63} as int))").alias("bit")
                         ).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MARK_BITS // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _chunk_batches(marks: Broadcast):
    """mapInArrow function: the chunks that may be repeated, with their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marks.value
        for batch in batches:
            for lo, _, data, offs in chunks(batch.column("text"), SLICE_BYTES):
                row, start, end = pieces(data, offs)
                sums = prefix_hash(data)
                place = chunk_hashes(sums, start, end) & np.uint64(MARK_BITS - 1)
                some = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
                row, start, end = row[some], start[some], end[some]
                raw = data.tobytes()
                digests = [hashlib.blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(start.tolist(), end.tolist(), strict=True)]
                before = chunk_hashes(sums, np.maximum(start - SIDE, offs[row]), start).astype(np.uint32).view(np.int32)
                after = chunk_hashes(sums, end, np.minimum(end + SIDE, offs[row + 1])).astype(np.uint32).view(np.int32)
                rows = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("version").take(rows),
                     pa.array((start - offs[row]).astype(np.int32)), pa.array((end - offs[row]).astype(np.int32)),
                     pa.array(before), pa.array(after), pa.array(digests, pa.binary())],
                    names=["doc_id", "version", "start", "end", "before", "after", "digest"])

    return run


def slices(batch: pa.RecordBatch, limit: int, texts: str | None = None, lists: str | None = None, each: int = 1) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, in order: the bytes of ``texts`` and ``each`` for every item of ``lists`` are at most ``limit``
    together; a row that has more is a part of its own."""
    size = np.zeros(len(batch), np.int64)
    if texts:
        size += pc.binary_length(batch.column(texts)).fill_null(0).to_numpy(zero_copy_only=False)
    if lists:
        size += each * pc.list_value_length(batch.column(lists)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    offs = np.concatenate(([0], np.cumsum(size)))
    lo = 0
    while lo < len(batch):
        hi = max(int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1, lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def _edge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both ends of every run, with the same place of the first occurrence.

    The second chunk from an end is another try where its first occurrence is not beside that of the outermost.
    An end can be extended by up to ``REACH`` bytes where the hashes of the ``SIDE`` bytes beside it agree, else by
    fewer than ``SIDE``. Runs that may meet so are a group; a group that stays below ``RUN_BYTES`` is left out.
    """
    for batch in batches:
        for part in slices(batch, SLICE_SPANS, lists="spans"):
            yield _edges(part)


def _edges(part: pa.RecordBatch) -> pa.RecordBatch:
    spans = part.column("spans").flatten()
    first = spans.field("first")
    row = np.repeat(np.arange(len(part)), pc.list_value_length(part.column("spans")).fill_null(0).to_numpy(zero_copy_only=False))
    order = np.lexsort((spans.field("start").to_numpy(), row))
    row = row[order]
    number = lambda column: column.to_numpy()[order].astype(np.int64)
    start, end, place = number(spans.field("start")), number(spans.field("end")), number(first.field("start"))
    # A run ends where the next chunk of the row starts behind all before it.
    reach = np.maximum.accumulate(end + (row << 32))
    at = np.flatnonzero(np.concatenate(([True], start[1:] + (row[1:] << 32) > reach[:-1]))) if len(row) else row
    until = np.append(at[1:], len(row)) if len(row) else row
    same = {side: (number(spans.field(beside)) == number(first.field(beside))).tolist() for side, beside in (("start", "before"), ("end", "after"))}
    runs = zip(row[at].tolist(), at.tolist(), until.tolist(), start[at].tolist(), (reach[until - 1] - (row[at] << 32)).tolist(), strict=True)
    docs, versions = part.column("doc_id").to_pylist(), part.column("version").to_pylist()
    where = list(zip(first.field("doc_id").take(pa.array(order)).to_pylist(), first.field("version").to_numpy()[order].tolist(),
                     (place - start).tolist(), strict=True))
    sides = {"start": start.tolist(), "end": end.tolist()}
    out: list[tuple] = []
    group, least, most, last = [], 0, -1, -1
    for k, begin, stop, lo, hi in runs:
        if k != last:
            out += group if most - least >= RUN_BYTES else []
            group, least, most, last = [], 0, -1, k
        edges, grows = [], {}
        for side, outer, step in (("start", begin, 1), ("end", stop - 1, -1)):
            grows[side] = SIDE - 1
            for c in (outer, outer + step)[:stop - begin]:
                if c == outer or where[c] != where[outer]:
                    at_place = sides[side][c]
                    edges.append((docs[k], versions[k], lo, hi, at_place, side == "end", *where[c][:2], where[c][2] + at_place))
                    if same[side][c]:
                        grows[side] = REACH
        if lo - grows["start"] > most:
            out += group if most - least >= RUN_BYTES else []
            group, least = [], lo - grows["start"]
        group += edges
        least, most = min(least, lo - grows["start"]), max(most, hi + grows["end"])
    out += group if most - least >= RUN_BYTES else []
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(EDGES)], schema=EDGES)


EDGES = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("place", pa.int32()),
                   ("ahead", pa.bool_()), ("first_id", pa.int64()), ("first_version", pa.int64()), ("first_place", pa.int32())])


def _beside_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``REACH`` bytes behind (ahead) or before places of a text."""
    types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
    for batch in batches:
        for part in slices(batch, SLICE_BYTES, "text", "places", REACH):
            out: list[tuple] = []
            for doc, version, text, places in zip(*(part.column(c).to_pylist() for c in ("doc_id", "version", "text", "places")), strict=True):
                raw = text.encode()
                for p in places:
                    at = p["first_place"]
                    out.append((doc, version, at, p["ahead"], raw[at:at + REACH] if p["ahead"] else raw[max(0, at - REACH):at]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)],
                                             names=["first_id", "first_version", "first_place", "ahead", "beside"])


def extended(raw: bytes, edges: list) -> list[tuple[int, int]]:
    """Runs of at least ``RUN_BYTES`` after extension, in whole words."""
    spans = []
    for e in edges:
        spans.append({"start": e["lo"], "end": e["hi"]})
        at, beside, k = e["place"], e["beside"], 0
        if e["ahead"]:
            while k < min(len(raw) - at, len(beside)) and raw[at + k] == beside[k]:
                k += 1
            spans.append({"start": at, "end": at + k})
        else:
            while k < min(at, len(beside)) and raw[at - 1 - k] == beside[-1 - k]:
                k += 1
            spans.append({"start": at - k, "end": at})
    out = []
    for lo, hi in merged(spans):
        if hi - lo < RUN_BYTES:
            continue
        while lo < hi and raw[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo and not (SPACES[raw[lo - 1]] or SPACES[raw[lo]]):
            lo = next((k for k in range(lo, min(lo + WORD_BYTES, hi)) if SPACES[raw[k]]), lo) if raw[lo] < 0xE0 else lo
        if hi < len(raw) and not (SPACES[raw[hi - 1]] or SPACES[raw[hi]]) and raw[hi] < 0xE0:
            hi = next((k for k in range(hi, max(hi - WORD_BYTES, lo), -1) if SPACES[raw[k - 1]]), hi)
        if 0 < lo < hi and SPACES[raw[lo]] and not SPACES[raw[lo - 1]]:
            lo += 1
        if lo < hi:
            out.append((lo, hi))
    return out


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, SLICE_BYTES, "text", "edges", REACH):
            yield _cut(part)


def _cut(part: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for text, edges in zip(part.column("text").to_pylist(), part.column("edges").to_pylist(), strict=True):
        if text is None or not edges:
            out.append((text, 0, 0))
            continue
        raw, kept, at = text.encode(), [], 0
        runs = extended(raw, edges)
        for start, end in runs:
            kept.append(raw[at:start])
            at = end
        kept.append(raw[at:])
        out.append((b"".join(kept).decode(), sum(e - s for s, e in runs), len(runs)))
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("row"),
         *(pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64())))],
        names=["doc_id", "row", "text", "n_removed", "n_spans"])


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of the spans (start, end), which may touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeated_chunks(own: DataFrame) -> DataFrame:
    """doc_id, version, spans: the chunks of each row that an earlier place has too, with that place."""
    marks = own.sparkSession.sparkContext.broadcast(repeated_marks(own))
    # Written: read for the first places and again for the others.
    found = written(own.mapInArrow(_chunk_batches(marks), "doc_id long, version long, start int, end int, before int, after int, digest binary"), "chunks")
    repeated = (found.groupBy("digest").agg(F.min(F.struct("doc_id", "version", "start", "before", "after")).alias("first"),
                                            F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.expr("version = first.version and start = first.start")
    return (found.join(repeated, "digest").where(~is_first).groupBy("doc_id", "version")
            .agg(F.collect_set(F.struct("start", "end", "before", "after", "first")).alias("spans")))


def run_edges(own: DataFrame) -> DataFrame:
    """doc_id, version, edges: the ends of each row's runs of repeated chunks and the bytes around their first occurrences."""
    # Written to stay: read for the places and again for the edges. The chunks go.
    with scratch(own.sparkSession) as keep:
        edges = keep(repeated_chunks(own).mapInArrow(
            _edge_batches, "doc_id long, version long, lo int, hi int, place int, ahead boolean, "
            "first_id long, first_version long, first_place int"), "run_edges")
    key = ["first_id", "first_version", "first_place", "ahead"]
    places = (edges.select(*key).distinct().groupBy("first_id", "first_version")
              .agg(F.collect_list(F.struct("first_place", "ahead")).alias("places")))
    held = own.join(places, own.doc_id.eqNullSafe(places.first_id) & (own.version == places.first_version))
    # Rows that repeat give their bytes again; the set of edges below holds them once.
    beside = held.select("doc_id", "version", "text", "places").mapInArrow(
        _beside_batches, "first_id long, first_version long, first_place int, ahead boolean, beside binary")
    e, b = edges.alias("e"), beside.alias("b")
    joined = e.join(b, F.expr(" and ".join(f"e.{k} <=> b.{k}" for k in key)))
    return (joined.select("doc_id", "version", F.struct("lo", "hi", "place", "e.ahead", "beside").alias("edge"))
            .groupBy("doc_id", "version").agg(F.collect_set("edge").alias("edges")))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts that are left; n_removed and n_spans (bytes and runs cut) are added.

    The other columns stay, whatever their names, but for ``n_chars``, which follows the new text, and
    for columns named as the new ones.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col, "doc_id", "text", "n_removed", "n_spans")]
    # The other columns travel in one struct, so no name of theirs meets one of these.
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)])
    whole = versioned(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), row.alias("row")))
    spans = run_edges(whole.select("doc_id", "text", "version")).withColumnsRenamed({"doc_id": "id", "version": "v"})
    joined = whole.join(spans, whole.doc_id.eqNullSafe(F.col("id")) & (F.col("version") == F.col("v")), "left").select(
        "doc_id", "row", "text", "edges")
    out = joined.mapInArrow(_cut_batches, T.StructType([
        joined.schema["doc_id"], joined.schema["row"], T.StructField("text", T.StringType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]))
    chars = F.length("text").cast("long")
    return out.select("doc_id", *[chars.alias(c) if c == "n_chars" else F.col(f"row.c{k}").alias(c) for k, c in enumerate(rest)],
                      "text", "n_removed", "n_spans")
