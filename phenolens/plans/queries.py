"""Registered queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the given parquet tables (through the clinical views of
:mod:`phenolens.sources.synthetic`) over their whole extent. Floating
results are rounded to 6 decimals so that they compare with the DuckDB
oracle of :mod:`phenolens.plans.oracle` value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_iso_date
from ..operators import cohort, features, metrics, moments, rule_table, stats
from ..rules import (
    SYNTHETIC_ALLOWED_CODES,
    SYNTHETIC_ALLOWED_DRUGS,
    SYNTHETIC_ALLOWED_LABS,
    SYNTHETIC_RULES,
)
from ..sources import synthetic
from ..sources.clinical import diagnostic_events, lab_events, load_event_tables, medication_events
from ..sources.csv import read_allow_list
from ..sources.sinks import read_feature_tuples, write_feature_tuples, write_labels
from ..sources.store import write_event_store
from ..streaming import kmeans as skm
from ..session import checkpoint_dir, materialize
from . import clustering, given, saved_model

Query = Callable[[SparkSession, str], DataFrame]

RULES = SYNTHETIC_RULES
DIGITS = 6
STREAM_K = 3
GIVEN_ITERATIONS = 3


def _r(c, name: str | None = None):
    col = F.round(F.col(c) if isinstance(c, str) else c, DIGITS)
    return col.alias(name or (c if isinstance(c, str) else None))


def _tables(spark: SparkSession, sf: str):
    return synthetic.synthetic_event_tables(spark, sf)


# --- S4-S6, P12-P17: event tables and text cleaning ---------------------------

def q_medication_events(spark, sf):
    return synthetic.synthetic_medication(spark, sf)


def q_lab_events(spark, sf):
    return synthetic.synthetic_lab(spark, sf)


def q_diagnostic_events(spark, sf):
    return synthetic.synthetic_diagnostic(spark, sf)


def q_parse_iso_dates(spark, sf):
    """ISO date-time text (rendered from ``events.ts``) parsed back to dates."""
    ev = synthetic.table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))
    return ev.select("event_id", parse_iso_date("iso").alias("date"))


def q_lab_events_from_text(spark, sf):
    """The raw-text lab cleaner over text rendered from ``events``.

    Numbers carry thousands separators (``format_number``), dates carry a time
    part; the cleaner must recover both.
    """
    raw = synthetic.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("Member_ID"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Date_Resulted"),
        F.col("event_type").alias("Result_Name"),
        F.format_number(F.col("value") * F.lit(100.0), 2).alias("Numeric_Result"),
    )
    return lab_events(raw).select("patient_id", "date", "test_name", _r("value"))


def q_medication_events_from_text(spark, sf):
    """The drug-order builder over raw text: encounters and orders as the CSV files hold them."""
    raw = synthetic.raw_frames(spark, sf)
    return medication_events(raw["encounter"], raw["med"])


def q_diagnostic_events_from_text(spark, sf):
    """The diagnosis builder over raw text."""
    raw = synthetic.raw_frames(spark, sf)
    return diagnostic_events(raw["encounter"], raw["encounter_dx"])


# --- C1-C12: cohort -----------------------------------------------------------

def q_dx_target_patients(spark, sf):
    return cohort.dx_target_patients(synthetic.synthetic_diagnostic(spark, sf), RULES)


def q_dx_related_patients(spark, sf):
    return cohort.dx_related_patients(synthetic.synthetic_diagnostic(spark, sf), RULES)


def q_lab_marker_patients(spark, sf):
    return cohort.lab_marker_patients(synthetic.synthetic_lab(spark, sf), RULES)


def q_lab_abnormal_patients(spark, sf):
    return cohort.lab_abnormal_patients(synthetic.synthetic_lab(spark, sf), RULES)


def q_cohort_case_branches(spark, sf):
    return cohort.case_branches(_tables(spark, sf), RULES)


def q_cohort_controls(spark, sf):
    return cohort.controls(_tables(spark, sf), RULES)


def q_phenotype_labels(spark, sf):
    return cohort.phenotype(_tables(spark, sf), RULES)


def q_phenotype_labels_from_csv(spark, sf):
    """End to end through the raw-text path.

    The driver tables are rendered as the four raw CSV inputs under
    ``spark.checkpoint.dir``, read back with the header CSV reader and the
    cleaners, labelled, exported as ``patient<TAB>label`` text and read back.
    Equals ``phenotype_labels``.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/phenolens-csv-{uuid.uuid4().hex}"
    synthetic.write_raw_csvs(spark, sf, f"{base}/raw")
    labels = cohort.phenotype(load_event_tables(spark, f"{base}/raw"), RULES)
    write_labels(labels, f"{base}/labels")
    return spark.read.schema("patient_id string, label int").option("sep", "\t").csv(f"{base}/labels")


def q_phenotype_label_counts(spark, sf):
    return cohort.label_counts(cohort.phenotype(_tables(spark, sf), RULES))


def q_phenotype_labels_patient_exclusion(spark, sf):
    return cohort.phenotype(_tables(spark, sf), RULES.with_exclusion("patient"))


def _compiled(spark, inline_terms=rule_table.INLINE_TERMS):
    """The rules read from a rule table; with no inline terms every list is joined as a long one."""
    return rule_table.compile_rules(rule_table.as_rule_table(spark, RULES), inline_terms)


def q_phenotype_labels_rule_table(spark, sf):
    return cohort.phenotype(_tables(spark, sf), _compiled(spark))


def q_phenotype_labels_long_lists(spark, sf):
    return cohort.phenotype(_tables(spark, sf), _compiled(spark, 0))


def q_cohort_case_branches_long_lists(spark, sf):
    return cohort.case_branches(_tables(spark, sf), _compiled(spark, 0))


def q_cohort_controls_rule_table(spark, sf):
    return cohort.controls(_tables(spark, sf), _compiled(spark))


def q_lab_mean_by_label_rule_table(spark, sf):
    out = cohort.label_stat(_tables(spark, sf), _compiled(spark))
    return out.select("label", _r("mean_value"), "n_rows")


def q_phenotype_labels_from_store(spark, sf):
    """Labels from an event store: the tables bucketed by patient, no exchange on the patient."""
    store = write_event_store(synthetic.synthetic_event_tables(spark, sf), buckets=8)
    return cohort.phenotype(store.tables(spark), RULES)


def q_lab_mean_by_label(spark, sf):
    """Two-input form: labels, then the lab table joined to them."""
    t = _tables(spark, sf)
    out = stats.lab_mean_by_label(t.lab, cohort.phenotype(t, RULES), RULES.stat_test)
    return out.select("label", _r("mean_value"), "n_rows")


def q_lab_mean_by_label_one_pass(spark, sf):
    """Same statistic with labels and sums from one aggregation."""
    out = cohort.label_stat(_tables(spark, sf), RULES)
    return out.select("label", _r("mean_value"), "n_rows")


# --- C13-C20: features ---------------------------------------------------------

def _tuples_all(spark, sf):
    return features.feature_tuples(_tables(spark, sf))


def _tuples_filtered(spark, sf):
    return features.feature_tuples(
        _tables(spark, sf), allow_codes=SYNTHETIC_ALLOWED_CODES,
        allow_drugs=SYNTHETIC_ALLOWED_DRUGS, allow_labs=SYNTHETIC_ALLOWED_LABS)


def _round_tuples(df):
    return df.select("patient_id", "feature", _r("value"))


def q_features_diagnostic(spark, sf):
    return features.diagnostic_features(synthetic.synthetic_diagnostic(spark, sf))


def q_features_medication(spark, sf):
    return features.medication_features(synthetic.synthetic_medication(spark, sf))


def q_features_lab(spark, sf):
    return _round_tuples(features.lab_features(synthetic.synthetic_lab(spark, sf)))


def q_features_diagnostic_filtered(spark, sf):
    return features.diagnostic_features(synthetic.synthetic_diagnostic(spark, sf), SYNTHETIC_ALLOWED_CODES)


def q_features_medication_filtered(spark, sf):
    return features.medication_features(synthetic.synthetic_medication(spark, sf), SYNTHETIC_ALLOWED_DRUGS)


def q_features_lab_filtered(spark, sf):
    return _round_tuples(features.lab_features(synthetic.synthetic_lab(spark, sf), SYNTHETIC_ALLOWED_LABS))


def q_feature_tuples_all(spark, sf):
    return _round_tuples(_tuples_all(spark, sf))


def q_feature_tuples_filtered(spark, sf):
    return _round_tuples(_tuples_filtered(spark, sf))


def q_feature_tuples_round_trip(spark, sf):
    """All tuples exported as tab-separated text and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/phenolens-tuples-{uuid.uuid4().hex}"
    write_feature_tuples(_tuples_all(spark, sf), path, fmt="tsv")
    return _round_tuples(read_feature_tuples(spark, path))


def q_feature_tuples_from_allow_files(spark, sf):
    """Both arms' tuples written once with their domain, then filtered by allow-lists read from text files.

    The lists are written as text first, in capitals where the names allow it:
    reading lower-cases them, and the match lowers both sides.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/phenolens-allow-{uuid.uuid4().hex}"
    lists = {"codes": SYNTHETIC_ALLOWED_CODES, "drugs": SYNTHETIC_ALLOWED_DRUGS, "labs": SYNTHETIC_ALLOWED_LABS}
    for kind, terms in lists.items():
        spark.createDataFrame([(t.upper(),) for t in terms], "value string").write.text(f"{base}/{kind}.txt")
    allow = {f"allow_{kind}": read_allow_list(spark, f"{base}/{kind}.txt") for kind in lists}
    tagged = materialize(features.tagged_tuples(_tables(spark, sf)), "tagged-tuples")
    return _round_tuples(features.allowed_tuples(tagged, **allow, case_insensitive=True))


def q_feature_index(spark, sf):
    return features.feature_index(_tuples_all(spark, sf))


def _space(spark, sf):
    return clustering.build_feature_space(_tuples_all(spark, sf))


def q_feature_matrix_long(spark, sf):
    return _space(spark, sf).matrix_long.select("patient_id", "idx", _r("value"))


def _moments(spark, sf):
    space = _space(spark, sf)
    n_patients = space.vectors.count()  # a count of the written vectors: one row a patient
    return space, n_patients, moments.feature_moments(space.matrix_long, n_patients)


def q_feature_moments(spark, sf):
    _, _, mom = _moments(spark, sf)
    return mom.select("idx", "n_present", _r("mean"), _r("sd"), _r("zero_value"))


def q_scaled_long(spark, sf):
    space, _, mom = _moments(spark, sf)
    return moments.scaled_long(space.matrix_long, mom, space.n_features).select(
        "patient_id", "idx", _r("value"))


def q_feature_covariance(spark, sf):
    space, n_patients, mom = _moments(spark, sf)
    cov = moments.feature_covariance(space.vectors, mom, n_patients, space.n_features)
    return cov.select("i", "j", _r("covariance"))


def q_patient_vectors(spark, sf):
    """The sparse vectors, their two arrays as text (values with six decimals)."""
    six = F.transform("values", lambda v: F.round(v, DIGITS).cast("decimal(18,6)").cast("string"))
    return _space(spark, sf).vectors.select(
        "patient_id", F.size("indices").cast("long").alias("n_entries"),
        F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"), F.array_join(six, ",").alias("values"))


# --- C21-C29: models and purity ----------------------------------------------

def q_pca_projection(spark, sf):
    """Spark ML's StandardScaler + PCA on sparse vectors."""
    space = _space(spark, sf)
    projected = clustering.score(clustering.fit_pipeline(space), space.vectors, space.n_features)
    return projected.select("patient_id", vector_to_array("pca").alias("pca"))


def q_pca_projection_long(spark, sf):
    """Scaler + PCA fitted from moments and the blocked Gram matrix, and applied to the long form."""
    space = _space(spark, sf)
    return clustering.score_long(clustering.fit_pca_long(space), space.matrix_long)


def q_score_saved_model(spark, sf):
    """Fit on the allow-listed tuples, save, load, and score all tuples with the loaded model.

    Names that the model has not seen drop out. With as many components as
    features the components are a rotation, so the squared length of a score is
    that of the scaled row whatever the components' signs.
    """
    space = clustering.build_feature_space(_tuples_filtered(spark, sf))
    path = f"{checkpoint_dir(spark).rstrip('/')}/phenolens-model-{uuid.uuid4().hex}"
    saved_model.save_model(clustering.fit_pca_long(space, space.n_features), space.index, path)
    scores = saved_model.score_new(saved_model.load_model(spark, path), _tuples_all(spark, sf))
    length = F.aggregate("pca", F.lit(0.0), lambda a, x: a + x * x)
    return scores.select("patient_id", F.size("pca").cast("long").alias("n_components"), _r(length, "squared_length"))


def _projection(spark, sf):
    return clustering.fit_projection(_space(spark, sf))[1]


def q_kmeans_clusters(spark, sf):
    return clustering.kmeans_clusters(_projection(spark, sf))


def q_gmm_clusters(spark, sf):
    return clustering.gmm_clusters(_projection(spark, sf))


def q_streaming_kmeans_clusters(spark, sf):
    return clustering.streaming_kmeans_clusters(_projection(spark, sf))


def q_purity_report(spark, sf):
    t = _tables(spark, sf)
    out = clustering.purity_report(
        cohort.phenotype(t, RULES), features.tagged_tuples(t), allow_codes=SYNTHETIC_ALLOWED_CODES,
        allow_drugs=SYNTHETIC_ALLOWED_DRUGS, allow_labs=SYNTHETIC_ALLOWED_LABS)
    return out.select("feature_set", "algorithm", "n_pairs", _r("purity"))


def _embedding_points(spark, sf):
    return synthetic.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def q_purity_from_pairs(spark, sf):
    """Embedding class against a fixed bucketing (``vec_id % 3``)."""
    pairs = synthetic.table(spark, sf, "embeddings").select(
        (F.col("vec_id") % 3).cast("int").alias("cluster"), "label")
    return metrics.purity(pairs).select("n_pairs", _r("purity"))


def q_purity_pairing(spark, sf):
    """Patients grouped by their number of drug orders (modulo 5) against the controls and cases, unmatched ones counted."""
    t = _tables(spark, sf)
    clusters = (t.med.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))
                .select("patient_id", (F.col("n") % 5).cast("int").alias("cluster")))
    labels = cohort.phenotype(t, RULES).where("label < 3")
    out = metrics.paired_purity(clusters, labels)
    return out.select("n_pairs", "n_unmatched_clusters", "n_unmatched_labels", _r("purity"))


def _first_points(points, k=STREAM_K):
    return [list(r["features"]) for r in points.orderBy("vec_id").limit(k).collect()]  # k start centres


def q_kmeans_from_centres(spark, sf):
    """Three Lloyd iterations over all embeddings from the points of the three lowest ids."""
    points = _embedding_points(spark, sf)
    model = given.kmeans_from(points, _first_points(points), iterations=GIVEN_ITERATIONS, tolerance=0.0)
    rows = [(i, float(model.sizes[i]), d, x) for i, c in enumerate(model.centres) for d, x in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, n double, dim int, center double").withColumn("center", _r("center"))


def q_mixture_em_step(spark, sf):
    """One EM step over all embeddings from three given means, unit covariance and equal weights."""
    points = _embedding_points(spark, sf)
    model, likelihood = given.em_step(points, given.Mixture.around(_first_points(points)))
    d = model.means.shape[1]
    rows = [(c, float(model.weights[c]), i, j, float(model.means[c, i]), float(model.covariances[c, i, j]), float(likelihood))
            for c in range(STREAM_K) for i in range(d) for j in range(i, d)]
    out = spark.createDataFrame(rows, "component int, weight double, i int, j int, mean double, covariance double, likelihood double")
    return out.select("component", _r("weight"), "i", "j", _r("mean"), _r("covariance"), _r("likelihood"))


def q_purity_cohort_modes(spark, sf):
    """Patient-mode labels as clusters against row-mode labels, paired by patient.

    Both labels come from one aggregation over the events.
    """
    both = cohort.phenotype_modes(_tables(spark, sf), RULES)
    pairs = both.select(F.col("label_patient").alias("cluster"), F.col("label_row").alias("label"))
    return metrics.purity(pairs).select("n_pairs", _r("purity"))


def q_streaming_kmeans_update(spark, sf):
    """One mini-batch update over all embeddings, every component.

    Start centres: the points of the three lowest ``vec_id`` (a top-k by
    id), weight 0.5 each; decay 1.0 per point.
    """
    points = _embedding_points(spark, sf)
    first = points.orderBy("vec_id").limit(STREAM_K).collect()  # k start centres
    centres = skm.centres_frame(spark, [list(r["features"]) for r in first], 0.5)
    new = skm.update(points, centres, decay=1.0, time_unit="points")
    return skm.centres_long(new).select("cluster", _r("weight"), "dim", _r("center"))


def q_streaming_kmeans_stream(spark, sf):
    """The same update driven by Structured Streaming over the embeddings file.

    The file arrives as one micro-batch, so the final centres equal
    ``streaming_kmeans_update``. State and stream offsets live in a fresh
    folder under ``spark.checkpoint.dir``.
    """
    points = _embedding_points(spark, sf)
    first = points.orderBy("vec_id").limit(STREAM_K).collect()  # k start centres
    centres = skm.centres_frame(spark, [list(r["features"]) for r in first], 0.5)
    base = f"{checkpoint_dir(spark).rstrip('/')}/phenolens-stream-{uuid.uuid4().hex}"
    model = skm.StreamingKMeans(f"{base}/state", centres, decay=1.0, time_unit="points")
    stream = synthetic.stream_table(spark, sf, "embeddings").select(
        F.col("embedding").cast("array<double>").alias("features"))
    final = skm.run_stream(stream, model, f"{base}/offsets")
    return skm.centres_long(final).select("cluster", _r("weight"), "dim", _r("center"))


QUERIES: dict[str, Query] = {
    "medication_events": q_medication_events,
    "lab_events": q_lab_events,
    "diagnostic_events": q_diagnostic_events,
    "parse_iso_dates": q_parse_iso_dates,
    "lab_events_from_text": q_lab_events_from_text,
    "dx_target_patients": q_dx_target_patients,
    "dx_related_patients": q_dx_related_patients,
    "lab_marker_patients": q_lab_marker_patients,
    "lab_abnormal_patients": q_lab_abnormal_patients,
    "cohort_case_branches": q_cohort_case_branches,
    "cohort_controls": q_cohort_controls,
    "phenotype_labels": q_phenotype_labels,
    "phenotype_label_counts": q_phenotype_label_counts,
    "phenotype_labels_from_csv": q_phenotype_labels_from_csv,
    "phenotype_labels_patient_exclusion": q_phenotype_labels_patient_exclusion,
    "lab_mean_by_label": q_lab_mean_by_label,
    "lab_mean_by_label_one_pass": q_lab_mean_by_label_one_pass,
    "features_diagnostic": q_features_diagnostic,
    "features_medication": q_features_medication,
    "features_lab": q_features_lab,
    "features_diagnostic_filtered": q_features_diagnostic_filtered,
    "features_medication_filtered": q_features_medication_filtered,
    "features_lab_filtered": q_features_lab_filtered,
    "feature_tuples_all": q_feature_tuples_all,
    "feature_tuples_filtered": q_feature_tuples_filtered,
    "feature_index": q_feature_index,
    "feature_matrix_long": q_feature_matrix_long,
    "feature_moments": q_feature_moments,
    "scaled_long": q_scaled_long,
    "feature_covariance": q_feature_covariance,
    "purity_from_pairs": q_purity_from_pairs,
    "purity_cohort_modes": q_purity_cohort_modes,
    "streaming_kmeans_update": q_streaming_kmeans_update,
    "streaming_kmeans_stream": q_streaming_kmeans_stream,
    "patient_vectors": q_patient_vectors,
    "pca_projection": q_pca_projection,
    "pca_projection_long": q_pca_projection_long,
    "kmeans_clusters": q_kmeans_clusters,
    "gmm_clusters": q_gmm_clusters,
    "streaming_kmeans_clusters": q_streaming_kmeans_clusters,
    "purity_report": q_purity_report,
    "medication_events_from_text": q_medication_events_from_text,
    "diagnostic_events_from_text": q_diagnostic_events_from_text,
    "phenotype_labels_rule_table": q_phenotype_labels_rule_table,
    "phenotype_labels_long_lists": q_phenotype_labels_long_lists,
    "cohort_case_branches_long_lists": q_cohort_case_branches_long_lists,
    "cohort_controls_rule_table": q_cohort_controls_rule_table,
    "lab_mean_by_label_rule_table": q_lab_mean_by_label_rule_table,
    "phenotype_labels_from_store": q_phenotype_labels_from_store,
    "feature_tuples_round_trip": q_feature_tuples_round_trip,
    "feature_tuples_from_allow_files": q_feature_tuples_from_allow_files,
    "score_saved_model": q_score_saved_model,
    "purity_pairing": q_purity_pairing,
    "kmeans_from_centres": q_kmeans_from_centres,
    "mixture_em_step": q_mixture_em_step,
}
