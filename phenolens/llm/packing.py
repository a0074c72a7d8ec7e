"""Best-fit packing of documents into bins of a fixed number of words.

Documents are cut into pieces of at most ``capacity`` words, then dealt by a
hash of (doc_id, piece) to shards of about ``SHARD_WORDS`` words, whose number
follows from the total. Every shard is packed by one task: pieces by falling
length; the open bins are ordered by what is left in them, each with a bitmap
of its sources and one of its duplicate clusters; from the first bin that has
room the search goes to the next larger ones until it meets one without the
piece's source and cluster, else a bin is opened. As the hash deals a hot
source or cluster to all shards alike, no shard grows with it.

The constraint of a cluster is strict between documents: two documents of one
cluster are never in one bin. A source fills at most ``SOURCE_SHARE`` places of
a bin, counted by bitmap levels (level k has the sources with more than k
pieces in the bin).

Cases: a null or blank text has no words and is in no bin, but it keeps a row
with a null bin. A null source or cluster conflicts with nothing. Repeated rows are packed
each; equal lengths go in the order of id and piece. A null ``doc_id`` is
packed like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import renamed, written

CAPACITY = 2048
SHARD_WORDS = 1 << 20
SOURCE_SHARE = 4

SCHEMA = "doc_id long, piece int, n_words int, shard long, bin int, position int, residual int"


def pack(lengths: list[int], sources: list[int], clusters: list[int], capacity: int,
         source_share: int = SOURCE_SHARE) -> list[tuple[int, int, int]]:
    """(bin, position, what is left in the bin at the end) of each piece, in the given order.

    Sources and clusters are small ints that name a bit, or -1.
    """
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    left: list[int] = []
    levels: list[list[int]] = []  # of each bin: bitmaps of sources by number of pieces
    groups: list[int] = []  # of each bin: bitmap of clusters
    held: list[int] = []
    out = []
    for n, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 1 << source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (n, -1))
        while at < len(order):
            b = order[at][1]
            if not (groups[b] & c or levels[b][-1] & s):
                break
            at += 1
        if at < len(order):
            del order[at]
        else:
            b = len(left)
            left.append(capacity)
            levels.append([0] * source_share)
            groups.append(0)
            held.append(0)
        left[b] -= n
        groups[b] |= c
        for k, have in enumerate(levels[b]):
            if not have & s:
                levels[b][k] |= s
                break
        out.append((b, held[b]))
        held[b] += 1
        if left[b]:
            insort(order, (left[b], b))
    return [(b, k, left[b]) for b, k in out]


def _pack_shard(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        codes = [pd.factorize(pdf[c])[0].tolist() for c in ("source", "cluster")]
        got = pack(pdf["n_words"].tolist(), *codes, capacity)
        pdf = pdf[["doc_id", "piece", "n_words", "shard"]].copy()
        for k, name in enumerate(("bin", "position", "residual")):
            pdf[name] = [x[k] for x in got]
        return pdf

    return run


def word_count(text):
    """Number of words (runs without ASCII white space), null as 0."""
    words = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(words == "", 0).otherwise(F.size(F.split(words, r"[\x20\x09-\x0D]+")))


def best_fit(docs: DataFrame, cluster, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             capacity: int = CAPACITY, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, piece, n_words, shard, bin, position, residual: a row for each piece.

    ``cluster`` is a column of ``docs`` (or an expression on it) that is equal
    for duplicates; (shard, bin) names a bin.
    """
    items = written(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.col(cluster).alias("cluster") if isinstance(cluster, str) else cluster.alias("cluster"),
        word_count(F.col(f"`{text_col}`")).alias("n")), "lengths")
    total = items.agg(F.sum("n")).first()[0] or 0
    shards = total // shard_words + 1
    pieces = (items.where("n > 0")
              .select("*", F.posexplode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int"))).alias("piece", "k"))
              .select("doc_id", "piece", "source", "cluster",
                      F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("int").alias("n_words"),
                      F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).alias("shard")))
    packed = pieces.groupBy("shard").applyInPandas(_pack_shard(capacity), SCHEMA)
    none = items.where("n = 0").selectExpr(
        "doc_id", "0 piece", "0 n_words", "cast(null as long) shard", "cast(null as int) bin",
        "cast(null as int) position", "cast(null as int) residual")
    return packed.unionByName(none)


def text_cluster(text):
    """Cluster of exact copies but for case and white space: two 64-bit hashes of the words."""
    words = F.lower(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")))
    return F.when(words != "", F.concat_ws(":", F.xxhash64(words), F.hash(words)))
