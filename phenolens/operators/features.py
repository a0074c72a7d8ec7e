"""Feature construction: long tuples, a dense feature index, patient vectors.

The canonical form is long: ``(patient_id string, feature string, value double)``.
Diagnoses and drug orders become counts, lab results become averages. The
index numbers the distinct feature names 0..n-1 in name order; vectors are
built per patient from the long form without any driver round trip.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, written_path
from ..sources.clinical import EventTables

# Above this many features the index is joined with a shuffle instead of
# being broadcast (about 100 bytes a name: 1M names ~ 100 MB on each executor
# is already past what a broadcast should carry, so stay well below).
BROADCAST_INDEX_MAX_ROWS = 200_000

INDEX_MAX_PARTITIONS = 64

Allow = Iterable[str] | DataFrame | None


def _allowed(df: DataFrame, allow: Allow, case_insensitive: bool) -> DataFrame:
    """Keep rows whose ``feature`` is in the allow-list.

    A Python collection becomes an ``isin`` predicate (pushed into the scan).
    A one-column DataFrame of terms (``term``) becomes a left semi join, which
    the callers put behind their aggregation: there a name that a third of all
    events carry has one row a patient. Its size is only known at run time, so
    the join strategy is left to AQE, which broadcasts the terms when they are
    few and splits a hot name otherwise.
    """
    if allow is None:
        return df
    name = F.lower(F.col("feature")) if case_insensitive else F.col("feature")
    if isinstance(allow, DataFrame):
        term_col = allow.columns[0]
        terms = allow.select(F.col(term_col).alias("_term"))
        if case_insensitive:
            terms = terms.select(F.lower("_term").alias("_term"))
        return df.join(terms, name == F.col("_term"), "left_semi")
    values = list(dict.fromkeys(allow))
    if case_insensitive:
        values = [v.lower() for v in values]
    return df.where(name.isin(values)) if values else df.where(F.lit(False))


def _grouped(rows: DataFrame, value: Column, allow: Allow, case_insensitive: bool) -> DataFrame:
    """``value`` per (patient, feature): a list of terms filters the scan, a table of terms the groups."""
    late = isinstance(allow, DataFrame)
    rows = rows if late else _allowed(rows, allow, case_insensitive)
    out = rows.groupBy("patient_id", "feature").agg(value.cast("double").alias("value"))
    return _allowed(out, allow, case_insensitive) if late else out


def count_features(events: DataFrame, name_col: str, allow: Allow = None,
                   case_insensitive: bool = False) -> DataFrame:
    """Number of rows per (patient, name) as a double value.

    With ``allow`` the raw name must be in the list; by default the match is
    case-sensitive, so a lower-cased list never matches mixed-case names.
    Rows with a null name are not features and are skipped.
    """
    df = events.select("patient_id", F.col(name_col).alias("feature")).where(
        F.col("feature").isNotNull())
    return _grouped(df, F.count(F.lit(1)), allow, case_insensitive)


def avg_features(events: DataFrame, name_col: str, value_col: str = "value",
                 allow: Allow = None, case_insensitive: bool = False) -> DataFrame:
    """Average value per (patient, name)."""
    df = events.select("patient_id", F.col(name_col).alias("feature"), F.col(value_col).alias("v")).where(
        F.col("feature").isNotNull())
    return _grouped(df, F.avg("v"), allow, case_insensitive)


def diagnostic_features(dx: DataFrame, allow: Allow = None, case_insensitive: bool = False) -> DataFrame:
    return count_features(dx, "code", allow, case_insensitive)


def medication_features(med: DataFrame, allow: Allow = None, case_insensitive: bool = False) -> DataFrame:
    return count_features(med, "medicine", allow, case_insensitive)


def lab_features(lab: DataFrame, allow: Allow = None, case_insensitive: bool = False) -> DataFrame:
    return avg_features(lab, "test_name", "value", allow, case_insensitive)


def tagged_tuples(tables: EventTables) -> DataFrame:
    """``(domain, patient_id, feature, value)``: the tuples of all three event tables with where they come from."""
    parts = (("dx", diagnostic_features(tables.dx)), ("lab", lab_features(tables.lab)), ("med", medication_features(tables.med)))
    return reduce(DataFrame.unionByName, [df.select(F.lit(domain).alias("domain"), *df.columns) for domain, df in parts])


def allowed_tuples(tagged: DataFrame, allow_codes: Allow = None, allow_drugs: Allow = None, allow_labs: Allow = None,
                   case_insensitive: bool = False) -> DataFrame:
    """The tuples of ``tagged_tuples`` that the lists of their domains allow (a missing list allows none)."""
    lists = {"dx": allow_codes, "lab": allow_labs, "med": allow_drugs}
    parts = [_allowed(tagged.where(F.col("domain") == domain), [] if allow is None else allow, case_insensitive)
             for domain, allow in lists.items()]
    return reduce(DataFrame.unionByName, parts).select("patient_id", "feature", "value")


def feature_tuples(tables: EventTables, allow_codes: Allow = None, allow_drugs: Allow = None,
                   allow_labs: Allow = None, case_insensitive: bool = False,
                   filtered: bool | None = None, prefix_domain: bool = False) -> DataFrame:
    """Union of diagnostic, lab and medication tuples.

    ``filtered`` defaults to "any allow-list given"; when filtered, a missing
    list keeps no rows of that domain (an empty list allows nothing). A name
    used in two domains for one patient gives two tuples; they are summed when
    vectors are built. ``prefix_domain=True`` keeps the domains apart instead
    (``dx:``, ``lab:``, ``med:`` prefixes).
    """
    if filtered is None:
        filtered = any(a is not None for a in (allow_codes, allow_drugs, allow_labs))

    def pick(a: Allow) -> Allow:
        if not filtered:
            return None
        return [] if a is None else a

    parts = [
        ("dx", diagnostic_features(tables.dx, pick(allow_codes), case_insensitive)),
        ("lab", lab_features(tables.lab, pick(allow_labs), case_insensitive)),
        ("med", medication_features(tables.med, pick(allow_drugs), case_insensitive)),
    ]
    out = None
    for domain, df in parts:
        if prefix_domain:
            df = df.select("patient_id", F.concat(F.lit(domain + ":"), "feature").alias("feature"), "value")
        out = df if out is None else out.unionByName(df)
    return out


def feature_index(tuples: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``(feature string, idx int)``: distinct names numbered 0..n-1 in name order.

    Distributed numbering, no single-partition window over the names: the
    distinct names are range-partitioned and sorted inside each partition, a
    row's position inside its partition comes from
    ``monotonically_increasing_id`` (partition id in the upper bits, position in
    the lower 33 bits), and the per-partition start offsets come from a
    running sum over the partition counts (one row per partition). The ranks
    are written once under ``spark.checkpoint.dir`` because two branches read
    them.
    """
    spark = tuples.sparkSession
    if num_partitions is None:
        # A dictionary of names is small next to the data, and 64 ranges hold
        # millions of names. With an explicit count AQE keeps the ranges as
        # they are, one partition id per range.
        num_partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), INDEX_MAX_PARTITIONS)
    names = tuples.select("feature").where(F.col("feature").isNotNull()).distinct()
    # Written once: the counts and the final join both read these ranks, so
    # the tuples upstream run once and both reads see the same positions.
    ranked = materialize(
        names.repartitionByRange(num_partitions, "feature")
        .sortWithinPartitions("feature")
        .withColumn("_mid", F.monotonically_increasing_id())
        .select(
            "feature",
            F.shiftright("_mid", 33).alias("_part"),
            F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        ),
        "feature-ranks",
    )
    counts = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a global window over it is tiny by construction.
    offsets = counts.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    return ranked.join(F.broadcast(offsets), "_part").select(
        "feature", (F.col("_offset") + F.col("_pos")).cast("int").alias("idx"))


def join_per_feature(rows: DataFrame, table: DataFrame, key: str, n_table: int,
                     salt_buckets: int = 32) -> DataFrame:
    """Inner join of per-patient rows with a one-row-per-feature table on ``key``.

    The table is broadcast when its row count ``n_table`` is at most
    :data:`BROADCAST_INDEX_MAX_ROWS`. Otherwise the join shuffles on
    (key, salt): each row gets a salt from its patient, and the table is
    copied once per salt value, so a feature carried by a large share of all
    rows is spread over ``salt_buckets`` tasks.
    """
    if n_table <= BROADCAST_INDEX_MAX_ROWS:
        return rows.join(F.broadcast(table), key)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("patient_id"), F.lit(salt_buckets)))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def indexed_tuples(tuples: DataFrame, index: DataFrame,
                   n_features: int | None = None, salt_buckets: int = 32) -> DataFrame:
    """``(patient_id, idx int, value double)``: each tuple with its feature number.

    Joined through :func:`join_per_feature` (bounded broadcast, else salted
    shuffle). A name used in two domains gives two rows with the same index.
    """
    if n_features is None:
        n_features = index.count()
    joined = join_per_feature(tuples, index, "feature", n_features, salt_buckets)
    return joined.select("patient_id", "idx", "value")


def feature_matrix_long(tuples: DataFrame, index: DataFrame,
                        n_features: int | None = None, salt_buckets: int = 32) -> DataFrame:
    """``(patient_id, idx int, value double)``, duplicates per (patient, idx) summed."""
    return (
        indexed_tuples(tuples, index, n_features, salt_buckets)
        .groupBy("patient_id", "idx")
        .agg(F.sum("value").alias("value"))
    )


def patient_vectors(long_form: DataFrame) -> DataFrame:
    """``(patient_id, indices array<int>, values array<double>)``: one sparse row per patient, indices rising.

    Takes ``(patient_id, idx, value)`` rows, summed per (patient, idx) or not:
    the rows are dealt by patient once, and both the sums of repeated indices
    and the grouping use that layout. A patient's row holds its present
    features only, so it is bounded by the dictionary and grows with the
    patient's own features, never with the dictionary.
    """
    summed = (long_form.repartition("patient_id").groupBy("patient_id", "idx")
              .agg(F.sum("value").alias("value")))
    entries = F.sort_array(F.collect_list(F.struct("idx", "value")))
    return summed.groupBy("patient_id").agg(entries.alias("_entries")).select(
        "patient_id", F.col("_entries.idx").alias("indices"), F.col("_entries.value").alias("values"))


def as_ml_vectors(vectors: DataFrame, n_features: int, label: str = "ml-vectors") -> DataFrame:
    """``(patient_id, features vector)``: the sparse rows as Spark ML vectors.

    A vector column is stored as a struct ``(type, size, indices, values)``;
    the rows are written in that form once and read back as vectors, so no row
    passes through Python and none is ever dense.
    """
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(n_features).alias("size"), "indices", "values")
    path = written_path(vectors.select("patient_id", stored.alias("features")), label)
    schema = T.StructType([T.StructField("patient_id", T.StringType()), T.StructField("features", VectorUDT())])
    return vectors.sparkSession.read.schema(schema).parquet(path)
