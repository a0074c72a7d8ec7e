"""Importance resampling towards a target distribution, over hashed word runs.

A text's features are all runs of 1 to ``max_words`` consecutive words, joined
by one space, with repeats; a feature's bucket is the CRC-32 of its UTF-8
bytes modulo ``buckets``. Bucket totals are counted over the whole raw corpus
and the whole target; a document's weight is the sum of its features' log
ratios, and the documents with the highest weights plus Gumbel noise (from a
hash of the id) are drawn without replacement.

Hashing is split into head and tail. Words are counted over the corpus, and
the ``HEAD_WORDS`` most frequent ones (of at most ``HEAD_BYTES`` bytes) are
broadcast with their exact CRC states, so that a known word costs one lookup
and a run that begins with one is continued from its state. Where runs of two
are asked for, the ``HEAD_PAIRS`` most frequent pairs of head words are
broadcast with their buckets. All else (the tail) takes the CRC of its bytes.
Both feed the same exact totals: the head decides the cost, never the result.

What reaches the driver is bounded by parameters: ``HEAD_WORDS`` words,
``HEAD_PAIRS`` pairs and ``buckets`` totals. Ranks come from a distributed
sort with one offset for each of its partitions.

Cases: a null or blank text has no words, weight 0 and is never drawn (it has
under ``min_words`` words). Rows that share a ``doc_id`` are rows of their own
with equal noise; a null ``doc_id`` counts as empty text in the noise and
comes last among equal scores. Ties go to the smaller id. Extra columns are
left behind. An empty corpus gives an empty result, an empty target only
smoothed totals.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import renamed, written

BUCKETS = 10_000
MAX_WORDS = 1
HEAD_WORDS, HEAD_BYTES, HEAD_PAIRS = 1 << 16, 64, 1 << 16
#: Distinct words (or pairs) that a task holds before it hands their counts on.
HELD = 1 << 18
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
FIXED_POINT = 1000

_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8: A-Z lower-cased, everything else in ASCII but letters and digits is a gap."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


@dataclass(frozen=True)
class Vocabulary:
    """The head: CRC state of each frequent word behind a space, bucket of each word and of frequent pairs."""

    states: dict[bytes, int]
    word_buckets: dict[bytes, int]
    pair_buckets: dict[tuple[bytes, bytes], int]
    buckets: int
    max_words: int

    def features(self, words: list[bytes]) -> np.ndarray:
        """Buckets of all features of a text's words."""
        known, size = self.word_buckets.get, self.buckets
        out = [zlib.crc32(w) % size if (b := known(w)) is None else b for w in words]
        if self.max_words > 1 and len(words) > 1:
            out += self._longer(words)
        return np.array(out, np.int64)

    def _longer(self, words: list[bytes]) -> list[int]:
        size, out = self.buckets, []
        # The state of each run so far with the space behind it.
        states = [zlib.crc32(w + b" ") if (s := self.states.get(w)) is None else s for w in words]
        for length in range(2, min(self.max_words, len(words)) + 1):
            ends = words[length - 1:]
            if length == 2:
                pair = self.pair_buckets.get
                out += [zlib.crc32(b, s) % size if (k := pair((a, b))) is None else k
                        for a, b, s in zip(words, ends, states, strict=False)]
            else:
                out += [zlib.crc32(b, s) % size for b, s in zip(ends, states, strict=False)]
            if length < self.max_words:
                states = [zlib.crc32(b + b" ", s) for b, s in zip(ends, states, strict=False)]
        return out


def _counts(column: str, keys, kind: pa.DataType):
    """mapInArrow function: (key, n) of what ``keys`` lists for each text, combined in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed():
            items = iter(held.items())
            while part := list(islice(items, 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], kind), pa.array([n for _, n in part], pa.int64())],
                                                 names=[column, "n"])
            held.clear()

        for batch in batches:
            for text in batch.column("text"):
                held.update(keys(text.as_py()))
                if len(held) >= HELD:
                    yield from flushed()
        yield from flushed()

    return run


def head(texts: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> Vocabulary:
    """The vocabulary of the frequent words of ``texts`` (column text), counted over all of them."""
    counts = texts.mapInArrow(_counts("word", words_of, pa.binary()), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where(F.length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(HEAD_WORDS).toArrow()
    frequent = top.column("word").to_pylist()
    states = {w: zlib.crc32(w + b" ") for w in frequent}
    word_buckets = {w: zlib.crc32(w) % buckets for w in frequent}
    pairs = {}
    if max_words > 1:
        shared = texts.sparkSession.sparkContext.broadcast(word_buckets)

        def pairs_of(text):
            words = words_of(text)
            return [a + b" " + b for a, b in zip(words, words[1:], strict=False) if a in shared.value and b in shared.value]

        pair_counts = (texts.mapInArrow(_counts("pair", pairs_of, pa.binary()), "pair binary, n long")
                       .groupBy("pair").agg(F.sum("n").alias("n")))
        found = pair_counts.orderBy(F.desc("n"), "pair").limit(HEAD_PAIRS).toArrow().column("pair").to_pylist()
        pairs = {tuple(p.split(b" ")): zlib.crc32(p) % buckets for p in found}
    return Vocabulary(states, word_buckets, pairs, buckets, max_words)


def totals(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Features of all texts in each bucket; one row a bucket leaves each task."""
    shared, size = texts.sparkSession.sparkContext.broadcast(vocabulary), vocabulary.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, out = shared.value, np.zeros(size, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(out, v.features(words_of(text.as_py())), 1)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed shares in the target and the raw corpus, in thousandths, floored."""
    size = len(raw)
    of_raw, of_target = float(raw.sum() + size), float(target.sum() + size)
    return np.array([math.floor(FIXED_POINT * math.log((t + 1.0) * of_raw / ((s + 1.0) * of_target)))
                     for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, vocabulary: Vocabulary, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, g = shared.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                found = v.features(words)
                out.append((len(words), len(found), int(g[found].sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([x[k] for x in out], pa.int64()) for k in range(3))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id, seed: int = SEED):
    """Gumbel noise in thousandths, floored, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, draw: int) -> DataFrame:
    """``scored`` with rank 1, 2, 3... by falling score, then id, of the first ``draw`` rows; null behind them.

    Places within a range partition and the partitions' sizes give the rank, so no task sees all rows.
    """
    place = F.monotonically_increasing_id()
    dealt = written(scored.repartitionByRange(F.desc("score"), F.asc_nulls_last("doc_id"))
                    .sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"))
                    .withColumns({"part": F.shiftright(place, 33), "place": place.bitwiseAND(F.lit((1 << 33) - 1))}), "ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("place") + 1
    return (dealt.join(F.broadcast(starts), "part")  # one row a partition
            .withColumn("rank", F.when(rank <= draw, rank)).drop("part", "place", "start"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             buckets: int = BUCKETS, max_words: int = MAX_WORDS, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) of every row of ``docs``.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred are drawn.
    """
    own = renamed(docs, {id_col: "doc_id", text_col: "text"})
    goal = renamed(target, {target_col: "text"})
    vocabulary = head(own.select("text"), buckets, max_words)
    gain = gains(totals(own.select("text"), vocabulary), totals(goal, vocabulary))
    scored = written(weighted(own, vocabulary, gain).withColumn("score", F.col("weight") + noise("doc_id", seed)), "scored")
    enough = F.col("n_words") >= min_words
    draw = percent * scored.where(enough).count() // 100
    return ranked(scored.where(enough), draw).unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
