"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space and between an ASCII letter and one of
``.,!?;:`` - places where the tokenizer's own pre-tokenizer always splits, so
the ids of a text are those of its words one after the other (a special token
holds no such place). Three steps:

1. Every slice of texts counts its distinct words; those found twice or more
   in a slice are added up by Spark. The most frequent ones, at most
   ``COMMON_WORDS`` of at most ``COMMON_BYTES`` bytes, are encoded once and
   sent to all tasks (a fixed bound of about 20 MB). They cover most of any text,
   so hot words need no shuffle.
2. Every other word leaves its text with its position. These rows are dealt by
   word and sorted, each distinct word is encoded once, and its ids go back to
   their texts by position. (A partition that one word overfills is split, and
   the word is encoded once in each part.)
3. Decoding joins ids to pieces (the vocabulary: a table of fixed size) and
   puts them together as the tokenizer's decoder does.

The path of the tokenizer file is a parameter; each task loads it by itself.

Cases: null and empty texts have no tokens. Rows that share a ``doc_id`` are
told apart by a hash of the text (equal rows are encoded each); a null
``doc_id`` is a row like others. Very long texts and words are taken whole.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, chunks, renamed, versioned, written

COMMON_WORDS = 1 << 19
COMMON_BYTES = 32
SLICE_BYTES = 1 << 20
ENCODED_AT_ONCE = 1000
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,!?;:"]] = True


def load(path: str):
    # One thread a task: the tasks are the parallel part, and each further thread holds memory of its own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def words(data: np.ndarray, offs: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(the words of the texts in order, the number of words before each text and in all)."""
    keep = ~SPACES[data]
    begins = np.ones(len(data), bool)
    begins[1:] = ~keep[:-1] | (_LETTER[data[:-1]] & _STOP[data[1:]])
    begins[offs[:-1][offs[:-1] < len(data)]] = True
    start = np.flatnonzero(keep & begins)
    compact = data[keep]
    ends = np.append(np.cumsum(keep)[start] - 1, len(compact))
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(compact)])
    return found.dictionary_encode(), np.searchsorted(start, offs)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offs in chunks(batch.column("text"), SLICE_BYTES):
            found, _ = words(data, offs)
            n = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            often = np.flatnonzero(n > 1)
            yield pa.RecordBatch.from_arrays(
                [found.dictionary.take(pa.array(often)).cast(pa.string()), pa.array(n[often], pa.int64())], names=["word", "count"])


def word_counts(docs: DataFrame) -> DataFrame:
    """word, count: the words found twice or more in a slice, with their number in all such slices."""
    return (docs.select("text").mapInArrow(_count_words, "word string, count long")
            .groupBy("word").agg(F.sum("count").alias("count")))


def _encode_words(path: str, kind: type, keep_word: bool):
    """Every row's word replaced by its ids; of a batch (and where one batch goes on with the last word) each word is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        last, last_ids = None, b""
        for batch in batches:
            if not len(batch):
                continue
            found = batch.column("word").dictionary_encode()
            distinct = found.dictionary.to_pylist()
            known = [last_ids] if distinct[0] == last else []
            for lo in range(len(known), len(distinct), ENCODED_AT_ONCE):
                some = tokenizer.encode_batch_fast(distinct[lo:lo + ENCODED_AT_ONCE], add_special_tokens=False)
                known += [np.array(x.ids, kind).tobytes() for x in some]
            last, last_ids = distinct[-1], known[-1]
            kept = batch if keep_word else batch.drop_columns(["word"])
            yield kept.append_column("ids", pa.array(known, pa.binary()).take(found.indices))

    return run


def common_words(docs: DataFrame, path: str, kind: type) -> pa.Table:
    """word, count, ids of the most frequent short words, the first ones first: those of the counts (by eighths of a power of two)
    that no more than ``COMMON_WORDS`` words reach."""
    short = written(word_counts(docs).where(F.octet_length("word") <= COMMON_BYTES)
                    .withColumn("level", F.floor(F.log2("count") * 8)), "words")
    levels = sorted(short.groupBy("level").count().collect(), reverse=True)  # at most 8 * 63 rows
    total, least = 0, 8 * 64
    for level, n in levels:
        total += n
        if total > COMMON_WORDS:
            break
        least = level
    return (short.where(F.col("level") >= least).select("word", "count")
            .mapInArrow(_encode_words(path, kind, True), "word string, count long, ids binary").toArrow()
            .sort_by([("count", "descending"), ("word", "ascending")]))


def _sent(table: pa.Table, kind: type) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(words, number of ids of each, ids)."""
    sink = pa.BufferOutputStream()
    names = table.select(["word"]).cast(pa.schema([("word", pa.large_string())]))
    with pa.ipc.new_stream(sink, names.schema) as out:
        out.write_table(names)
    ids = table.column("ids").to_pylist()
    size = np.dtype(kind).itemsize
    return sink.getvalue().to_pybytes(), np.array([len(x) // size for x in ids], np.int64), np.frombuffer(b"".join(ids), kind)


def _names(known: tuple[bytes, np.ndarray, np.ndarray]) -> pa.Array:
    return pa.concat_arrays([pa.array([], pa.large_string()), *pa.ipc.open_stream(known[0]).read_all().column(0).chunks])


def _look_up(batch: pa.RecordBatch, table: pa.Array):
    """For slices of the rows: (first row, row after the last, words, words before each row, place of each word in the table).

    Places count from 1; a word that is not in the table has 0.
    """
    for lo, hi, data, offs in chunks(batch.column("text"), SLICE_BYTES):
        found, bounds = words(data, offs)
        place = pc.fill_null(pc.index_in(found.dictionary, value_set=table), -1).to_numpy() + 1
        yield lo, hi, found, bounds, place[found.indices.to_numpy()]


def _rare(common):
    """Every word that is not among the frequent ones, with its position in its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _names(common.value)
        for batch in batches:
            for lo, hi, found, bounds, place in _look_up(batch, table):
                at = np.flatnonzero(place == 0)
                row = np.searchsorted(bounds, at, "right") - 1
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id").take(pa.array(row)), own.column("version").take(pa.array(row)),
                     pa.array((at - bounds[row]).astype(np.int32)),
                     found.dictionary.take(found.indices.take(pa.array(at))).cast(pa.string())],
                    names=["doc_id", "version", "at", "word"])

    return run


def _begin(common):
    """The places of a text's words in the table of frequent words; the position of this row is -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _names(common.value)
        squeeze = zstandard.ZstdCompressor(3)
        for batch in batches:
            for lo, hi, _, bounds, place in _look_up(batch, table):
                # Byte by byte: frequent words have small places, so that the higher bytes are mostly zero.
                parts = place.astype("<u4").view(np.uint8).reshape(-1, 4).T
                packed = [squeeze.compress(parts[:, i:j].tobytes()) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("version"), pa.array(np.full(hi - lo, -1, np.int32)), pa.array(packed, pa.binary())],
                    names=["doc_id", "version", "at", "ids"])

    return run


def _filled(packed: bytes, at: list[np.ndarray], parts: list[bytes], first: np.ndarray, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The ids of a text from the places of its words and the ids of the words at the other positions."""
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    places = np.ascontiguousarray(places.reshape(4, -1).T).view("<u4").ravel()
    n = size[places]
    rare = []
    if parts:
        # Equal rows (same id and text) list each position as often as there are rows.
        own = np.unique(np.concatenate(at), return_index=True)[1]
        rare = [np.frombuffer(parts[i], flat.dtype) for i in own.tolist()]
        n[places == 0] = [len(w) for w in rare]
    ends = np.cumsum(n)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    if len(flat):
        ids[:] = flat.take(np.arange(len(ids)) + np.repeat(first[places] - ends + n, n), mode="clip")
    if rare:
        ids[np.repeat(places == 0, n)] = np.concatenate(rare)
    return ids


def _merge(common):
    """doc_id, ids from rows sorted by document and position: the places of a text's words come first, once for each copy."""
    def flushed(texts: list, table: tuple) -> pa.RecordBatch:
        owner, out = [], []
        for (doc, null, _), copies, packed, at, parts in texts:
            ids = _filled(packed, at, parts, *table)
            owner += [None if null else doc] * copies
            out += [ids] * copies
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
        flat = np.concatenate(out) if out else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(owner, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, size, flat = common.value
        table = np.concatenate(([0], np.cumsum(size) - size)), np.concatenate(([0], size)), flat
        text = None
        for batch in batches:
            doc = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            version, at, ids = batch.column("version").to_numpy(), batch.column("at").to_numpy(), batch.column("ids")
            new = (doc[1:] != doc[:-1]) | (null[1:] != null[:-1]) | (version[1:] != version[:-1])
            cuts = np.concatenate(([0], np.flatnonzero(new) + 1, [len(batch)])) if len(batch) else [0]
            done = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                key = (int(doc[lo]), bool(null[lo]), int(version[lo]))
                if text is None or text[0] != key:
                    done += [text] if text else []
                    text = [key, 0, b"", [], []]
                copies = int(np.count_nonzero(at[lo:hi] < 0))
                if copies:
                    text[1], text[2] = text[1] + copies, ids[lo].as_py()
                if lo + copies < hi:
                    text[3].append(at[lo + copies:hi])
                    text[4] += ids.slice(lo + copies, hi - lo - copies).to_pylist()
            if done:
                yield flushed(done, table)
        if text:
            yield flushed([text], table)

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) of every row."""
    own = versioned(renamed(docs, {id_col: "doc_id", text_col: "text"}))
    kind = np.uint16 if load(path).get_vocab_size() <= 1 << 16 else np.uint32
    known = docs.sparkSession.sparkContext.broadcast(_sent(common_words(own, path, kind), kind))
    rows = "doc_id long, version long, at int, ids binary"
    rare = (own.mapInArrow(_rare(known), "doc_id long, version long, at int, word string")
            .hint("rebalance", "word").sortWithinPartitions("word").mapInArrow(_encode_words(path, kind, False), rows))
    return (own.mapInArrow(_begin(known), rows).union(rare)
            .repartition("doc_id", "version").sortWithinPartitions("doc_id", "version", "at")
            .mapInArrow(_merge(known), "doc_id long, ids array<int>"))


def pieces(path: str) -> list[str]:
    """The vocabulary by id: as long as the tokenizer's, whatever the data."""
    tokenizer = load(path)
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]


def _decode(table, with_digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = np.array(table.value, object)
        number = np.array([str(i) for i in range(len(piece))], object)
        for batch in batches:
            ids, texts, n, digests = batch.column("ids"), [], [], []
            flat, offs = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                own = flat[lo:hi]
                texts.append(" ".join(piece[own]))
                n.append(hi - lo)
                digests.append(" ".join(number[own]))
            if with_digest:
                texts, digests = ([hashlib.sha256(x.encode()).hexdigest() for x in y] for y in (texts, digests))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the pieces of the ids joined as by a tokenizer that has no decoder (one space)."""
    table = encoded.sparkSession.sparkContext.broadcast(pieces(path))
    return encoded.mapInArrow(_decode(table, False), "doc_id long, text string")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text."""
    table = encoded.sparkSession.sparkContext.broadcast(pieces(path))
    return encoded.mapInArrow(
        _decode(table, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
