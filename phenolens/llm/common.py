"""Byte-level helpers that the text operators share.

All of them work on one Arrow batch (or a bounded slice of it) at a time, so
a task's memory depends on the batch and on its longest text alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, written_path

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read again; within ``scratch`` the folder goes at its end."""
    path = written_path(df, label)
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Owner of the tables that ``written`` makes within it: at the end it deletes exactly those folders.

    It yields a function that writes a table to stay: what is read after the end must come from such a
    table, or from the caller's own.
    """
    owned: list[str] = []
    before = _OWNED.set(owned)
    try:
        yield materialize
    finally:
        _OWNED.reset(before)
        for path in owned:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Exactly the columns an operator needs; others (and clashes) are left behind."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def versioned(docs: DataFrame, name: str = "version") -> DataFrame:
    """``docs`` with a version: 0, or a hash of the text where ids are not unique."""
    twice = docs.groupBy("doc_id").count().where("count > 1")
    return docs.withColumn(name, F.lit(0).cast("long") if twice.isEmpty() else F.xxhash64("text"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def texts_of(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of slices of about ``limit`` bytes.

    The bytes are those of the rows' texts in UTF-8, one behind the other;
    a null is an empty text. A longer text is a slice of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(size, BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums, inverse powers): bytes [s, e) hash to ``(p[e] - p[s]) * inv[s]``."""
    size = 1 << max(20, int(len(data) + 1).bit_length())
    up, down = _powers(size)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out, down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every run of bytes other than ASCII white space, in order."""
    n = len(data)
    gap = SPACES[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.ones(n, bool)
    after = np.ones(n, bool)
    before[1:] = gap[:-1]
    after[:-1] = gap[1:]
    start = np.flatnonzero(~gap & (before | edge[:n]))
    end = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    p, down = prefix_hash(data)
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))


def run_ids(keys: np.ndarray) -> np.ndarray:
    """0, 0, 1, 2, 2, ... for consecutive equal values."""
    return np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
