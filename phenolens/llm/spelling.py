"""Groups of spelling variants, by blocked Gram matrices of letter counts.

Words are the maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole
texts, A-Z lower-cased. Two words are near if one inserted, deleted or
replaced code point turns one into the other. Such words have vectors of
letter counts whose squared distance is 1 or 2, and lengths that differ by at
most one.

The vocabulary is dealt into blocks by length, and within a length by the
number of letters in each of ``GROUPS`` groups (a letter's code point modulo
``GROUPS``): one edit changes the numbers of at most two groups by one, so
near words lie in the same or in neighbouring blocks. Blocks above ``CHUNK``
words are dealt into chunks by a hash. For each pair of chunks of neighbouring
blocks one NumPy product of the two count matrices gives all squared
distances; pairs at 2 or less are compared letter by letter. A chunk pair is a
row, so Spark spreads them, and a task holds two chunks at a time.

A word's form is its near word with the most occurrences (ties: the smallest
in code-point order) if that has at least ``RATIO`` times the word's. Every
step to a form multiplies the occurrences by ``RATIO``, so chains are short;
roots are found by looking forms up through themselves.

``noisy`` is the part of the query that plants misspellings: an occurrence of
a run whose hash with the document's id is divisible by ``EVERY`` loses one
code point.

Cases: null and blank texts have no words. Rows that share a ``doc_id`` are
rows of their own (and lose the same code points); a null ``doc_id`` counts as
empty text in the hash. Repeated rows count each time. Extra columns are left
behind. An empty table, or one without a word frequent enough, gives an empty
result. Long texts cost memory in proportion to their length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import renamed, written

EVERY = 199
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
GROUPS = 4
CHUNK = 1024
#: Distinct words that a task holds before it hands their counts on.
HELD = 1 << 18

# The letters are those of Latin-1; there A-Z are lower-cased and all else is a gap.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
#: Place of each code point in a vector of letter counts.
_PLACE = np.zeros(256, np.int64)
_PLACE[0x61:0x7B] = np.arange(26)
_PLACE[0xC0:0x100] = 26 + np.arange(64)
_LETTER_COUNT = 26 + 64


def runs_of(text: str | None) -> list[bytes]:
    """Runs of letters of a text, in Latin-1 (a code point outside is a gap), one byte a letter."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def noisy(run: bytes, state: int, every: int) -> bytes:
    """The run, less one code point if the CRC that goes on from ``state`` is divisible by ``every``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), state)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """word, n of all words of the texts (columns doc_id, text), whatever their length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed():
            items = iter(held.items())
            while part := list(islice(items, 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w, _ in part], pa.string()),
                                                  pa.array([n for _, n in part], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                state = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # Equal runs of a document have the same hash: one look at each.
                for own, n in Counter(runs_of(text)).items():
                    held[noisy(own, state, every)] += n
                if len(held) >= HELD:
                    yield from flushed()
        yield from flushed()

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("word <> ''")


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of letter counts for each word (float32: exact for whole numbers of this size)."""
    raw = "".join(words).encode("latin-1")
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cell = row * _LETTER_COUNT + _PLACE[np.frombuffer(raw, np.uint8)]
    return np.bincount(cell, minlength=len(words) * _LETTER_COUNT).reshape(-1, _LETTER_COUNT).astype(np.float32)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def near_pairs(left: list[str], right: list[str], same: bool) -> Iterator[tuple[int, int]]:
    """Places (in left, in right) of near words; ``same``: both lists are one, each pair comes once."""
    for lo in range(0, len(left), CHUNK):
        x = letter_counts(left[lo:lo + CHUNK])
        for at in range(lo if same else 0, len(right), CHUNK):
            y = letter_counts(right[at:at + CHUNK])
            squared = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)
            for i, j in zip(*(k.tolist() for k in np.nonzero(squared <= 2)), strict=True):
                if not (same and lo + i >= at + j) and one_edit(left[lo + i], right[at + j]):
                    yield lo + i, at + j


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("words_a", "counts_a", "words_b", "counts_b", "same")
        for words_a, counts_a, words_b, counts_b, same in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            found = list(near_pairs(words_a, words_b, same))
            both = [(words_a[i], words_b[j], counts_b[j]) for i, j in found] + [(words_b[j], words_a[i], counts_a[i]) for i, j in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in both], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                names=["word", "near", "near_n"])


def moves(groups: int) -> list[tuple[int, ...]]:
    """(change of length, of each group's number) from a block to itself and its neighbours, one of each two directions."""
    zero = [0] * groups
    out = [(0, *zero)]
    for i in range(groups):
        out.append((1, *(zero[:i] + [1] + zero[i + 1:])))
        for j in range(i + 1, groups):
            out.append((0, *(1 if k == i else -1 if k == j else 0 for k in range(groups))))
    return out


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of every pair of near words of (word, n)."""
    groups = F.transform(F.split("word", ""), lambda c: F.ascii(c) % GROUPS)
    # The numbers of letters in the groups add up to the length.
    numbers = [(F.size(groups) - F.size(F.array_remove(groups, k))).alias(f"g{k}") for k in range(GROUPS)]
    blocked = words.select("word", "n", F.length("word").alias("size"), *numbers)
    key = ["size", *(f"g{k}" for k in range(GROUPS))]
    sizes = blocked.groupBy(*key).agg(F.count("*").alias("held"))
    dealt = blocked.join(sizes, key).withColumn(
        "chunk", F.pmod(F.xxhash64("word"), F.ceil(F.col("held") / CHUNK)).cast("int"))
    chunks = written(dealt.groupBy(*key, "chunk").agg(F.collect_list(F.struct("word", "n")).alias("rows")).select(
        *key, "chunk", F.col("rows.word").alias("words"), F.col("rows.n").alias("counts")), "word_chunks")
    steps = F.explode(F.array(*[F.array(*map(F.lit, m)) for m in moves(GROUPS)])).alias("move")
    moved = chunks.select(*key, "chunk", steps).select(
        *[F.col(c).alias(f"{c}_a") for c in (*key, "chunk")], *[(F.col(c) + F.col("move")[k]).alias(c) for k, c in enumerate(key)])
    chunk_pairs = (moved.join(chunks.select(*key, "chunk"), key)
                   .withColumn("here", F.expr(" and ".join(f"{c} = {c}_a" for c in key)))
                   .where("not here or chunk_a <= chunk"))
    left = chunks.select(*[F.col(c).alias(f"{c}_a") for c in (*key, "chunk")],
                         F.col("words").alias("words_a"), F.col("counts").alias("counts_a"))
    right = chunks.select(*key, "chunk", F.col("words").alias("words_b"), F.col("counts").alias("counts_b"))
    work = (chunk_pairs.join(left, [f"{c}_a" for c in (*key, "chunk")]).join(right, [*key, "chunk"])
            .select("words_a", "counts_a", "words_b", "counts_b", F.expr("here and chunk_a = chunk").alias("same")))
    # Dealt by both chunks, so that a large block's pairs are spread.
    work = work.repartition(F.xxhash64("words_a"), F.xxhash64("words_b"))
    return work.mapInArrow(_pair_batches, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every (word, form): the end of the chain of forms."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        at = step.select("word", "root")
        if step.where("went").isEmpty():
            return at


def group_variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of (word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.minus") >= RATIO * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n")), "forms")
    root = roots(formed.where("form is not null"))
    return formed.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY) -> DataFrame:
    """``group_variants`` of the words of at least ``LEAST_CHARS`` code points and ``LEAST_COUNT`` occurrences."""
    counts = word_counts(renamed(docs, {id_col: "doc_id", text_col: "text"}), every)
    return group_variants(written(counts.where((F.length("word") >= LEAST_CHARS) & (F.col("n") >= LEAST_COUNT)), "words"))
