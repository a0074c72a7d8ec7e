"""Quality rules in DataFrame functions: base rules and a hashed n-gram likelihood ratio.

A document is read as its words and as the last ``TAIL`` characters of each
word (character n-grams, which also see words met nowhere else). Both are hashed to ``BUCKETS`` buckets. Two multinomials over
the buckets are counted: the raw corpus (every document, combined before the
shuffle to one row per bucket and task) and the trusted target (every
document labelled as of good quality). The score of a document is the mean of
``log target(bucket) - log raw(bucket)`` over its n-grams. The threshold is
fixed by all labelled documents of at least ``MIN_WORDS`` words, as the base
rules reject the others: the value that separates good from bad best, see
``threshold_of``. A document is kept if the base rules pass and its score
reaches the threshold.

Only sums over ``BUCKETS`` rows and the best cut reach the driver. The labels
are broadcast up to ``BROADCAST_LABELS``; more are joined by one shuffle, and
the labelled documents are then written once for the two passes over them.

Cases: a null or blank text has no words and fails the base rules; its score
is 0. Rows are judged one by one: repeated rows get equal verdicts, ties with
the threshold are kept, null ids do not matter. Extra columns stay, but those
named like a result are replaced by it, and ``INNER`` names are kept for the work. Without
usable labels every document that passes the base rules is kept. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, written

GAPS = " \t\n\x0b\x0c\r"
SIGNS = "#*$%&|<>"
BUCKETS = 4096
TAIL = 3
PLACES = 1 << 24
#: Labels that may be broadcast (some 60 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Bins that a unit of the score is cut into: running sums go bin by bin.
SCORE_BINS = 1000
MIN_WORDS = 50
SMOOTHING = 0.5
INNER = ("__words", "__hashes", "__tails", "__packed")


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    threshold: float


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bound(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` with columns that are computed once a row, whatever reads or filters them further on.

    They are the fields of the only row that a generator makes: the optimizer neither puts what they stand
    for back into the functions that read them nor moves a filter on them below.
    """
    return docs.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def read(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with __words, __hashes (of the words) and __tails (buckets of the words' last characters)."""
    line = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D]", " ")
    out = bound(docs, __words=F.array_remove(F.split(line, " "), ""))
    return bound(out, __hashes=F.transform("__words", lambda w: F.xxhash64(w)),
                 __tails=F.transform("__words", lambda w: bucket(F.xxhash64(F.substring(w, -TAIL, TAIL)))))


def bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def n_repeat_words(hashes: Column, packed: Column) -> Column:
    """Words in windows of three words that occur twice or more, the first included.

    ``packed`` has the windows' hashes, cut to 39 bits, with their places, sorted; windows that
    agree there are compared by the whole hashes of their words.
    """
    place = lambda e: e.bitwiseAND(F.lit(PLACES - 1)).cast("int")
    whole = lambda e: F.xxhash64(*(F.get(hashes, place(e) + k) for k in range(3)))

    def covered(some):
        starts = F.filter(some, lambda e, j: (whole(e) == F.when(j > 0, whole(F.get(some, j - 1))).otherwise(F.bitwise_not(whole(e))))
                          | (whole(e) == F.when(j < F.size(some) - 1, whole(F.get(some, j + 1))).otherwise(F.bitwise_not(whole(e)))))
        starts = F.sort_array(F.transform(starts, place))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
        return F.aggregate(starts, zero, lambda a, i: F.struct(
            (i + 3).alias("end"), (a["total"] + i + 3 - F.greatest(i, a["end"])).alias("total")))["total"]

    # The packed values are sorted: a neighbour has the same hash if only the places differ.
    again = F.filter(packed, lambda e, j: (F.get(packed, j + 1) <= e.bitwiseOR(F.lit(PLACES - 1)))
                     | (F.get(packed, j - 1) >= e.bitwiseAND(F.lit((1 << 63) - PLACES))))
    return let(again, lambda some: F.when(F.size(some) == 0, 0).otherwise(covered(some)))


def base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``read`` documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    window = F.transform("__hashes", lambda h, i: F.xxhash64(h, F.get("__hashes", i + 1), F.get("__hashes", i + 2))
                         .bitwiseAND(F.lit((1 << 63) - PLACES)).bitwiseOR(i.cast("long")))
    out = bound(docs, __packed=F.sort_array(F.slice(window, 1, F.greatest(F.size("__hashes") - 2, F.lit(0)))))
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.concat_ws("", "__words")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(f"[{SIGNS}]")).cast("long"),
        "n_dup_lines": let(F.filter(F.split(whole, "\n", -1), lambda line: F.btrim(line, F.lit(GAPS)) != ""),
                           lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": n_repeat_words(F.col("__hashes"), F.col("__packed")).cast("long"),
    })
    return out.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def score(weights: tuple[float, ...]) -> Column:
    """Mean weight of the n-grams of a ``read`` document."""
    table = F.split(F.lit(",".join(f"{w:.4f}" for w in weights)), ",").cast("array<double>")
    words = F.aggregate("__hashes", F.lit(0.0), lambda a, h: a + F.get(table, bucket(h)))
    tails = F.aggregate("__tails", F.lit(0.0), lambda a, b: a + F.get(table, b))
    return F.when(F.size("__hashes") > 0, (words + tails) / (F.size("__hashes") + F.size("__tails"))).otherwise(0.0)


def threshold_of(scored: DataFrame) -> float:
    """Of the labelled scores (s, quality): halfway between the good and the bad side of the best cut.

    The cut has the largest sum of the shares kept of the good and rejected of the bad; a good
    document lost counts five times, as a filter should rather keep. Every score is a place to cut:
    running sums within bins of the score, and over the bins, give what lies below it.
    """
    each = written(scored.where("quality in (0, 1)").groupBy("s")
                   .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
                   .withColumn("bin", F.floor(F.col("s") * SCORE_BINS)), "scores")
    n = each.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not n.good or not n.bad:
        return -math.inf
    # The weights bound the score, so the bins are some ten thousand at most.
    every, inside = Window.orderBy("bin"), Window.partitionBy("bin").orderBy("s")
    before = lambda c: F.coalesce(F.sum(c).over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = (each.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("s").alias("first"))
            .select("bin", before("good").alias("good_before"), before("bad").alias("bad_before"),
                    F.lead("first").over(every).alias("next_first")))
    upto = lambda c: F.col(f"{c}_before") + F.sum(c).over(inside)
    times = lambda c, k: c.cast("decimal(18,0)") * F.lit(k).cast("decimal(18,0)")
    cuts = each.join(F.broadcast(bins), "bin").select(
        "s", F.coalesce(F.lead("s").over(inside), "next_first", F.col("s") + 1).alias("next"),
        (times(upto("bad"), n.good) - times(5 * upto("good"), n.bad)).alias("gain"))
    best = cuts.where("gain > 0").orderBy(F.desc("gain"), "s").first()
    return (best.s + best.next) / 2 if best else -math.inf


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a label, and their quality."""
    if known.count() <= BROADCAST_LABELS:
        return docs.join(F.broadcast(known), "doc_id")
    return written(docs.join(known, "doc_id"), "labelled")


def bucket_counts(docs: DataFrame) -> list[int]:
    """Number of n-grams of all ``docs`` in each bucket."""
    counts = (read(docs).select(F.explode(F.concat(F.transform("__hashes", bucket), "__tails")).alias("bucket"))
              .groupBy("bucket").count().collect())
    out = [0] * BUCKETS
    for row in counts:
        out[row["bucket"]] = row["count"]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Bucket weights from all documents and all good ones, threshold from all labelled ones."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    with scratch(docs.sparkSession):
        judged = labelled(own, known)
        target = bucket_counts(judged.where("quality = 1"))
        all_target = sum(target)
        if not all_target:
            return Model((0.0,) * BUCKETS, -math.inf)
        raw = bucket_counts(own)
        share = lambda c, all_: math.log((c + SMOOTHING) / (all_ + SMOOTHING * BUCKETS))
        all_raw = sum(raw)
        weights = tuple(share(t, all_target) - share(r, all_raw) for t, r in zip(target, raw, strict=True))
        return Model(weights, threshold_of(
            read(judged).where(F.size("__words") >= MIN_WORDS).select(score(weights).alias("s"), "quality")))


def with_verdict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the base columns, score and kept."""
    out = base(read(docs.drop(*INNER), text), text).withColumn("score", score(model.weights))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(float(model.threshold))))
    return out.drop(*INNER)
