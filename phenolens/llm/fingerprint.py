"""Document fingerprints by order min-hash, in DataFrame functions.

The elements of a text are its k-mers of ``K`` words (the last ones are
shorter), each numbered by its occurrence, so a repeated k-mer is a new
element. A hash of (k-mer, occurrence) puts every element into one of
``SKETCHES`` bins and orders it there. Of every bin the ``TUPLE`` smallest
elements are taken, put back into the order of the text, and their k-mers are
hashed as a tuple. Two fingerprints are alike in the share of bins with equal
tuples (of those that either text fills): moving or changing a part of the
text changes the tuples that it holds a member of, so likeness follows edits
and not only the set of k-mers. The bins are looked up among the ``SMALLEST``
elements of the text, which is part of the sketch's definition.

The successor of a document in the order of ids comes from a range-partitioned
table of ids alone; texts move once to meet the heads of their successors.

Cases: a null text counts as empty; an empty or blank text has an empty
fingerprint, like only to another such (1.0, else 0.0). Rows are ordered by
(doc_id, version), nulls first, where the version is a hash of the text if ids
repeat, else 0; equal rows count as one document and get equal results. A
single document is its own successor. Texts of up to 16 million words are
placed exactly; beyond, places wrap around. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import renamed, versioned, written
from .quality import let

K = 2
SKETCHES = 16
TUPLE = 2
SMALLEST = 128
PLACES = 1 << 24
_TOP = (1 << 63) - PLACES


def fingerprints(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: an array of SKETCHES hashes, null where a bin is empty."""
    line = F.regexp_replace(F.col(text), r"[\x09-\x0D]", " ")
    place = lambda e: e.bitwiseAND(F.lit(PLACES - 1)).cast("int")
    docs = docs.withColumn("__w", F.array_remove(F.split(line, " "), ""))
    docs = docs.withColumn("__k", F.transform("__w", lambda w, i: F.xxhash64(w, *(F.get("__w", i + j) for j in range(1, K)))))
    docs = docs.withColumn("__p", F.transform("__k", lambda h, i: h.bitwiseAND(F.lit(_TOP)).bitwiseOR(i.cast("long"))))
    docs = docs.withColumn("__p", F.sort_array("__p"))
    # Runs of one k-mer in the sorted elements number its occurrences.
    docs = docs.withColumn("__r", F.filter(
        F.transform("__p", lambda e, j: F.when(F.coalesce(F.get("__p", j - 1) < e.bitwiseAND(F.lit(_TOP)), F.lit(True)), j)),
        lambda j: j.isNotNull()))
    occurrence = F.when(F.size("__r") < F.size("__p"), F.flatten(F.transform("__r", lambda s, r: F.sequence(
        F.lit(0), F.coalesce(F.get("__r", r + 1), F.size("__p")) - s - 1))))
    # Bound once for each row: a column that is read in one place would move into the inner function.
    docs = docs.withColumn("__e", let(occurrence, lambda o: F.transform("__p", lambda e, j: F.xxhash64(
        e.bitwiseAND(F.lit(_TOP)), F.coalesce(F.get(o, j), F.lit(0))).bitwiseAND(F.lit(_TOP)).bitwiseOR(e.bitwiseAND(F.lit(PLACES - 1))))))
    docs = docs.withColumn("__e", F.slice(F.sort_array("__e"), 1, SMALLEST))

    def sketch(b: int) -> Column:
        own = F.filter("__e", lambda e: F.shiftright(e, 24).bitwiseAND(F.lit(SKETCHES - 1)) == b)
        members = F.sort_array(F.transform(F.slice(own, 1, TUPLE), place))
        return let(members, lambda m: F.when(F.size(m) > 0, F.xxhash64(F.transform(m, lambda i: F.get("__k", i)))))

    return docs.withColumn(out, F.array(*(sketch(b) for b in range(SKETCHES)))).drop("__w", "__k", "__p", "__r", "__e")


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins that either fingerprint fills in which they agree; 1 if both are empty."""
    filled = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda x: x))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
    return F.when(filled == 0, F.lit(1.0)).otherwise(same / filled)


def as_string(fingerprint: Column) -> Column:
    return F.when(F.size(F.filter(fingerprint, lambda x: x.isNotNull())) == 0, "").otherwise(
        F.array_join(F.transform(fingerprint, lambda x: F.coalesce(F.lower(F.hex(x)), F.lit("-"))), ":"))


def successors(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, version, ...) with next_id and next_version; the first follows the last."""
    own = written(keys.repartitionByRange("doc_id", "version").withColumn("part", F.spark_partition_id()), "order")
    key = F.struct("doc_id", "version")
    # One row for each partition; nothing that grows with the documents.
    parts = own.groupBy("part").agg(F.min(key).alias("first"))
    order = Window.orderBy("part")
    parts = parts.select("part", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("after"))
    inside = own.withColumn("next", F.lead(key).over(Window.partitionBy("part").orderBy("doc_id", "version")))
    return (inside.join(parts, "part").withColumn("next", F.coalesce("next", "after"))
            .select(*keys.columns, F.col("next.doc_id").alias("next_id"), F.col("next.version").alias("next_version")))


def edited_texts(own: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, version, text, n_chars, edited: the last quarter replaced by the successor's head."""
    heads = links.select(
        F.col("next_id").alias("from_id"), F.col("next_version").alias("from_version"),
        F.col("doc_id").alias("to_id"), F.col("version").alias("to_version"), "n_chars", F.floor(F.col("n_chars") / 4).alias("part"))
    heads = (own.join(heads, own.doc_id.eqNullSafe(heads.from_id) & own.version.eqNullSafe(heads.from_version))
             .select("to_id", "to_version", "n_chars", "part", F.expr("substring(text, 1, cast(part as int))").alias("head"))
             .dropDuplicates(["to_id", "to_version"]))
    joined = own.join(heads, own.doc_id.eqNullSafe(heads.to_id) & own.version.eqNullSafe(heads.to_version))
    return joined.select("doc_id", "version", "text", "n_chars",
                         F.expr("concat(substring(text, 1, cast(n_chars - part as int)), head)").alias("edited"))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    own = versioned(renamed(docs, {id_col: "doc_id", text_col: "text"}))
    own = own.withColumn("text", F.coalesce("text", F.lit("")))
    keys = own.select("doc_id", "version", F.length("text").cast("long").alias("n_chars")).distinct()
    links = written(successors(keys), "links")
    both = fingerprints(fingerprints(edited_texts(own, links), "text", "a"), "edited", "b")
    both = written(both.select("doc_id", "version", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "a", "b"), "fingerprints")
    following = both.select(F.col("doc_id").alias("i"), F.col("version").alias("v"), F.col("a").alias("c")).dropDuplicates(["i", "v"])
    next_of = links.select(F.col("doc_id").alias("d"), F.col("version").alias("w"), "next_id", "next_version")
    pairs = (next_of.join(following, F.col("next_id").eqNullSafe(F.col("i")) & F.col("next_version").eqNullSafe(F.col("v")))
             .select("d", "w", "c"))
    out = both.join(pairs, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("version").eqNullSafe(F.col("w")))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_string(F.col("a")).alias("fingerprint"),
        as_string(F.col("b")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"))
