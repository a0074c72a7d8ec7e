"""Set similarity join on word shingles, filtered under several global orders of the tokens.

A document is the set of its distinct five-word shingles (64-bit hashes of
lower-cased words). Two sets x, y of similarity t share at least
``t / (1 + t) * (|x| + |y|)`` tokens, and so, under every global order of the
tokens, also some of their first ones. Three orders are used, and a pair must
pass all of them before its full sets are compared:

* order 1, the token hash, on single sets. Of the first
  ``|x| - t|x| + l`` tokens (``l`` a ``MARGIN`` share of the set) a linked pair
  shares at least ``l``, so a set fewer of whose first tokens occur in any other
  set has no partner. What remains is a small part of the corpus, of which one
  document of each class is read again.
* order 2, document frequency among the sets that are left, rarest first, on
  pairs. A pair is a candidate if it shares a token and no more tokens stand
  before that one than a link allows, in either set: with positions i and j,
  ``min(|x| - i, |y| - j) >= t / (1 + t) * (|x| + |y|)``, which the first shared
  token of a linked pair meets. A passage of thousands of documents is
  frequent, so it stands last and makes candidates only of documents that
  consist of it.
* orders 1 and 3 (another hash) on those pairs: the first ``|x| - t|x| + 1``
  tokens must have one in common under both.

Sets that are equal are one class first, so copies are never paired. Classes
that share a token of order 2 are not all paired either, as only connected
components are wanted: each such class is compared with the one of the group
that has the largest share of its tokens elsewhere (in a group of near copies
that is the original), then with the next such one outside its component, and
at last every two classes that are candidates and still in different
components. So no link between components is lost, and a group of near copies
costs about as many comparisons as it has members.

Cases: a null or blank text has an empty set and is linked with nothing. Rows
that share a ``doc_id`` are versions of one document and are linked through
it; a null ``doc_id`` is linked with nothing (component null). Ties go to the
smaller id. Extra columns are left behind. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix, renamed, scratch, written
from .shingle_sets import connected_components, shingles

PERCENT = 80
#: Share of a set (in percent) that order 1 looks at beyond the shortest prefix, and that must be shared.
MARGIN = 20
#: Rounds that compare with one class of each group, before the last one.
CENTRE_ROUNDS = 2
#: Ids of documents that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_ORDER_3 = np.uint64(0xD6E8FEB86659FD93)


def up(share: Column | np.ndarray, of: Column | np.ndarray):
    """ceil(share * of / 100) in whole numbers."""
    if isinstance(of, Column):
        return F.ceil((of * share) / F.lit(100.0) - F.lit(1e-9))
    return -(-of * share // 100)


def prefix_size(n, percent: int):
    """Tokens of which a set of n shares one at least with any partner, under any order."""
    return n - up(percent, n) + 1


def set_batches(percent: int, first_only: bool):
    """mapInArrow function: doc_id, n, the class (hash of the set) and either order 1's first tokens or all of them with two prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("text")):
                at, value = shingles(data, offs)
                rows = hi - lo
                n = np.bincount(at, minlength=rows).astype(np.int64)
                cls = np.zeros(rows, np.uint64)
                np.add.at(cls, at, mix(value))
                cls = mix(cls ^ n.astype(np.uint64))
                start = np.concatenate(([0], np.cumsum(n)))
                # Shingles come sorted by hash within a row: order 1.
                place = np.arange(len(at)) - start[at]
                size = np.minimum(prefix_size(n, percent) - 1 + up(MARGIN, n), n) if first_only else prefix_size(n, percent)
                first = place < size[at]
                columns = [batch.column("doc_id").slice(lo, rows), pa.array(n), pa.array(cls.view(np.int64))]
                names = ["doc_id", "n", "cls"]
                if first_only:
                    columns.append(_lists(at[first], value[first], rows))
                    names.append("first")
                else:
                    order = np.lexsort((mix(value ^ _ORDER_3), at))
                    third = value[order][first]
                    low = lambda x: x.astype(np.uint32).view(np.int32)  # noqa: E731  enough to tell that none is shared
                    columns += [_lists(at, value, rows), _lists(at[first], low(value[first]), rows), _lists(at[first], low(third), rows)]
                    names += ["tokens", "order1", "order3"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _lists(at: np.ndarray, value: np.ndarray, rows: int) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.view(np.int64) if value.dtype == np.uint64 else value))


def with_partners(sets: DataFrame, percent: int) -> DataFrame:
    """doc_id of one document of each class that order 1 leaves: enough of its first tokens occur in another class too.

    The tokens and their classes are dealt once, and both the bounds of each token and the rows
    that have it read that exchange.
    """
    some = sets.where("n > 0 and doc_id is not null and cls is not null")  # the latter is implied, but makes both plans equal
    first = some.select(F.explode("first").alias("token"), "cls").repartition("token")
    shared = (first.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
              .where("lo < hi").select("token").hint("shuffle_hash"))
    # Copies repeat the rows of their class.
    found = first.join(shared, "token").distinct().groupBy("cls").agg(F.count("*").alias("found"))
    classes = some.groupBy("cls").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id"))
    # The partner is at least percent of this set in size, and so is its margin of this one's.
    return classes.join(found, "cls").where(F.col("found") >= up(MARGIN, up(percent, F.col("n")))).select("doc_id").distinct()


def of_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with these ids: by a broadcast of the ids up to ``BROADCAST_IDS``, else by a shuffle."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def placed(classes: DataFrame, percent: int) -> DataFrame:
    """token, cls, n, pos, own: the places under order 2 of the tokens among each class's first ones that other classes have too.

    ``own`` is the number of the class's tokens that no other has.
    """
    every = classes.select("cls", "n", F.explode("tokens").alias("token"))
    shared = every.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    listed = (every.join(shared.hint("shuffle_hash"), "token").groupBy("cls", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
              .withColumn("own", F.col("n") - F.size("shared"))
              .where(F.col("own") < prefix_size(F.col("n"), percent)))
    # Tokens that occur once stand first under order 2.
    spread = listed.select("cls", "n", "own", F.posexplode(F.slice(
        "shared", 1, (prefix_size(F.col("n"), percent) - F.col("own")).cast("int"))).alias("at", "x"))
    return spread.select(F.col("x.token").alias("token"), "cls", "n", (F.col("own") + F.col("at")).alias("pos"), "own")


def candidate(percent: int) -> Column:
    """Whether order 2 lets the rows (n, pos) and (n_b, pos_b) of one token be its pair's first shared one."""
    return ((100 + percent) * F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b"))
            >= percent * (F.col("n") + F.col("n_b")))


def second(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("token", *[F.col(c).alias(f"{c}_b") for c in ("cls", "n", "pos", *more)])


def confirmed(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes those that pass orders 1 and 3 and whose full sets are similar enough."""
    def side(name: str, *columns: str) -> DataFrame:
        return classes.select(F.col("cls").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    passed = (pairs.join(side("a", "order1", "order3"), "a").join(side("b", "order1", "order3"), "b")
              .where(F.arrays_overlap("order1_a", "order1_b") & F.arrays_overlap("order3_a", "order3_b")).select("a", "b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (passed.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b")
            .select("a", "b", both.alias("both"), (F.size("tokens_a") + F.size("tokens_b")).alias("sizes"))
            .where(100 * F.col("both") >= percent * (F.col("sizes") - F.col("both"))).select("a", "b"))


def linked(classes: DataFrame, percent: int, more: DataFrame | None = None) -> DataFrame:
    """node, component of the classes (cls, n, tokens, order1, order3) that are linked; ``more`` are links known before."""
    first = written(placed(classes, percent), "placed")
    groups = first.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    first = written(first.join(groups, "token"), "grouped")
    links = written(more if more is not None else first.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0), "links")
    component = connected_components(links)
    for last in [False] * CENTRE_ROUNDS + [True]:
        tagged = first.join(component, first.cls == component.node, "left").select(
            *first.columns, F.coalesce("component", "cls").alias("c"))
        bounds = tagged.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
        tagged = written(tagged.join(bounds, "token"), "tagged")
        if last:
            others = second(tagged, "c").where("c_b is not null")
            met = tagged.join(others, "token").where((F.col("c") < F.col("c_b")) & candidate(percent))
        else:
            # The component that most of the group may be in is found from its most central class.
            centre = F.min_by(F.struct("cls", "n", "pos", "c"), F.struct(F.col("own") / F.col("n"), F.col("cls")))
            centres = (tagged.groupBy("token").agg(centre.alias("x")).select("token", *[
                F.col(f"x.{k}").alias(f"{k}_b") for k in ("cls", "n", "pos", "c")]))
            met = tagged.join(centres, "token").where((F.col("c") != F.col("c_b")) & candidate(percent))
        pairs = written(met.select(F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b")).distinct(), "pairs")
        links = written(links.union(confirmed(pairs, classes, percent)), "links")
        component = connected_components(links)
    return component


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row of ``docs``."""
    with scratch(docs.sparkSession) as keep:
        return keep(_joined(renamed(docs, {id_col: "doc_id", text_col: "text"}), percent), "joined")


def _joined(docs: DataFrame, percent: int) -> DataFrame:
    sets = written(docs.mapInArrow(set_batches(percent, True), "doc_id long, n long, cls long, first array<long>"), "sets")
    known = sets.where("n > 0 and doc_id is not null").select("doc_id", "cls")
    alive = written(with_partners(sets, percent), "partners")
    classes = written(
        of_documents(docs, alive).mapInArrow(
            set_batches(percent, False),
            "doc_id long, n long, cls long, tokens array<long>, order1 array<int>, order3 array<int>")
        .where("n > 0").dropDuplicates(["cls"]).drop("doc_id"), "classes")
    # Versions of one document are linked through their id.
    versions = known.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a < b").select("doc_id", "a")
    same_id = known.join(versions, "doc_id").where("a < cls").select("a", F.col("cls").alias("b")).distinct()
    component = linked(classes, percent, same_id)
    smallest = known.groupBy("cls").agg(F.min("doc_id").alias("rep")).join(component, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("component", "cls").alias("component"))
    smallest = written(smallest, "members")
    ids = smallest.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = smallest.join(ids, "component").select("cls", "component_id")
    some = sets.where("n > 0").select("doc_id", "n", "cls").join(by_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    none = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return reduce(DataFrame.unionByName, (some, none))
