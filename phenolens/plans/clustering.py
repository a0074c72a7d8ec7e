"""Unsupervised phenotyping: standardise, PCA, cluster, score by purity.

The clusterers are Spark ML's own (driver coordinates, executors scan); only
model parameters (k centres, the PC matrix) reach the driver. The projected
rows feed three fits, so they are written once under ``spark.checkpoint.dir``,
dealt by a hash of the patient and sorted: the fits then read a fixed,
lineage-free input (same layout every run, so a fixed seed repeats; a lost
executor re-reads the files instead of recomputing the feature pipeline).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import (
    Allow,
    allowed_tuples,
    as_ml_vectors,
    feature_index,
    indexed_tuples,
    join_per_feature,
    patient_vectors,
)
from ..operators.metrics import paired_by_patient, purity
from ..operators.moments import feature_moments, gram_blocks, matrix_of, moment_arrays
from ..session import materialize as materialize_table
from ..session import together
from ..streaming.kmeans import assign, random_centres, update
from .subspace import LinearProjection, fit_subspace

# Settings of the published experiment.
K_CLUSTERS = 3
PCA_COMPONENTS = 10
SEED = 6250
KMEANS_MAX_ITER = 20
STREAM_CENTRE_WEIGHT = 0.5
STREAM_DECAY = 1.0
STREAM_TIME_UNIT = "points"
#: Up to so many features the correlation matrix (8 bytes a cell) is taken to the driver: 128 MB.
DRIVER_FEATURES = 4096


@dataclass
class FeatureSpace:
    index: DataFrame          # (feature, idx)
    matrix_long: DataFrame    # (patient_id, idx, value)
    vectors: DataFrame        # (patient_id, indices array<int>, values array<double>), sparse
    n_features: int


def build_feature_space(tuples: DataFrame, materialize: bool = True, written: bool = False) -> FeatureSpace:
    """Index, long matrix and sparse patient vectors from feature tuples.

    The tuples feed the index, its size and the vectors. With ``materialize``
    they are written once under ``spark.checkpoint.dir``, and so are the
    vectors: the aggregated tuples are far smaller than the raw events, so
    writing them beats re-running the event scans and joins for every
    consumer, and a lost executor re-reads them. Tuples that are rows of a
    ``written`` table already are read from there. The long matrix lists the
    vectors' entries, so neither join nor shuffle is repeated for it.
    """
    if materialize and not written:
        tuples = materialize_table(tuples, "feature-tuples")
    # The index reads its ranks from a table written once (see feature_index).
    index = feature_index(tuples)
    n_features = index.count()
    vectors = patient_vectors(indexed_tuples(tuples, index, n_features))
    if materialize:
        vectors = materialize_table(vectors, "patient-vectors")
    long_form = vectors.select("patient_id", F.explode(F.arrays_zip("indices", "values")).alias("e")).select(
        "patient_id", F.col("e.indices").alias("idx"), F.col("e.values").alias("value"))
    return FeatureSpace(index, long_form, vectors, n_features)


# Rows per partition of the projected points (k=10 doubles, ~100 bytes a row).
PROJECTION_ROWS_PER_PARTITION = 200_000


def _stable(df: DataFrame, label: str, key: str = "patient_id") -> DataFrame:
    """Layout that depends on the rows alone: written once, dealt by a hash of the key, sorted.

    The partition count follows the row count (one partition per
    :data:`PROJECTION_ROWS_PER_PARTITION` rows). The rows are dealt after the
    read-back, as Spark packs file splits by the number of cores.
    """
    written = materialize_table(df, label)
    parts = max(1, -(-written.count() // PROJECTION_ROWS_PER_PARTITION))
    return written.repartition(parts, key).sortWithinPartitions(key)


def checked_k(k: int, n_features: int, clip_k: bool = False) -> int:
    if n_features < k and not clip_k:
        raise ValueError(f"PCA with k={k} needs at least {k} features, got {n_features}")
    return min(k, n_features)


def fit_projection(space: FeatureSpace, k: int = PCA_COMPONENTS, clip_k: bool = False) -> tuple[LinearProjection, DataFrame]:
    """Standardise and PCA(k); returns the model and ``(patient_id, pca vector)``.

    The projection is ``scaled row x PC matrix`` (not re-centred). PCA needs
    at least ``k`` features; ``clip_k=True`` lowers k to the feature count.
    Neither fitting nor projecting makes a patient's row dense outside a task.
    """
    model = fit_pca_long(space, checked_k(k, space.n_features, clip_k))
    scored = score_long(model, space.matrix_long).select("patient_id", array_to_vector("pca").alias("pca"))
    return model, _stable(scored, "projection")


def fit_pipeline(space: FeatureSpace, k: int = PCA_COMPONENTS, clip_k: bool = False) -> PipelineModel:
    """The same model as a Spark ML pipeline (StandardScaler with mean and std, then PCA), fitted to sparse vectors."""
    return Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        PCA(k=checked_k(k, space.n_features, clip_k), inputCol="scaled", outputCol="pca"),
    ]).fit(as_ml_vectors(space.vectors, space.n_features))


def score(model: PipelineModel, vectors: DataFrame, n_features: int) -> DataFrame:
    """Project new patients with a fitted scaler + PCA pipeline: ``(patient_id, pca)``."""
    return model.transform(as_ml_vectors(vectors, n_features)).select("patient_id", "pca")


def fit_pca_long(space: FeatureSpace, k: int = PCA_COMPONENTS) -> LinearProjection:
    """Standardise + PCA from sparse vectors.

    Up to ``DRIVER_FEATURES`` features the correlation matrix is folded in
    blocks (``gram_blocks``) and its eigenvectors are taken on the driver, as
    Spark ML's PCA does. Above, no n x n matrix is built anywhere: see
    :func:`phenolens.plans.subspace.fit_subspace`. Components are sorted by
    explained variance; the sign of each is arbitrary, as in any PCA.
    """
    n = space.n_features
    checked_k(k, n)
    n_patients = space.vectors.count()
    mom = materialize_table(feature_moments(space.matrix_long, n_patients), "moments")
    if n > DRIVER_FEATURES:
        return fit_subspace(space.matrix_long, mom, n_patients, n, k)
    mean, std = moment_arrays(mom, n)
    corr = matrix_of(gram_blocks(space.vectors, n, mean), n) / max(n_patients - 1.0, 1.0)
    w = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    corr *= w[:, None] * w
    values, vectors = np.linalg.eigh(corr)
    order = np.argsort(values)[::-1][:k]
    total = values[values > 0].sum()
    return LinearProjection(mean, std, vectors[:, order], values[order] / total if total > 0 else None)


def score_long(model: PipelineModel | LinearProjection, long_form: DataFrame) -> DataFrame:
    """Project patients from ``(patient_id, idx, value)`` rows, never densifying.

    Scaling and projection are linear: ``scaled_i = (x_i - mean_i) * w_i``
    with ``w_i = 1 / sd_i`` (0 for a constant feature), and the projection is
    ``sum_i scaled_i * PC_i``. So every present tuple adds
    ``value * w_i * PC_i`` to its patient, and the absent zeros add one
    constant ``-sum_i mean_i * w_i * PC_i``. The weighted PC rows (features x k
    model parameters) are joined like the feature index (bounded broadcast,
    else salted shuffle); one ``groupBy(patient_id)`` with partial sums does
    the rest. Result ``(patient_id, pca array<double>)`` equals ``score`` on
    the dense vectors, for patients with at least one tuple.
    """
    params = model if isinstance(model, LinearProjection) else LinearProjection.from_pipeline(model)
    mean, std, pc = params.mean, params.std, params.pc
    w = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    weighted = pc * w[:, None]
    offset = -(mean * w) @ pc
    n, k = pc.shape
    spark = long_form.sparkSession
    table = spark.createDataFrame(
        [(i, weighted[i].tolist()) for i in range(n)], "idx int, wpc array<double>")
    parts = join_per_feature(long_form, table, "idx", n).select(
        "patient_id", *[(F.col("value") * F.col("wpc")[d]).alias(f"_c{d}") for d in range(k)])
    sums = parts.groupBy("patient_id").agg(*[F.sum(f"_c{d}").alias(f"_c{d}") for d in range(k)])
    return sums.select(
        "patient_id",
        F.array(*[F.col(f"_c{d}") + F.lit(float(offset[d])) for d in range(k)]).alias("pca"))


def kmeans_clusters(projection: DataFrame, k: int = K_CLUSTERS, seed: int = SEED,
                    max_iter: int = KMEANS_MAX_ITER) -> DataFrame:
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="pca",
                   predictionCol="cluster").fit(projection)
    return model.transform(projection).select("patient_id", F.col("cluster").cast("int"))


def gmm_clusters(projection: DataFrame, k: int = K_CLUSTERS, seed: int = SEED) -> DataFrame:
    model = GaussianMixture(k=k, seed=seed, featuresCol="pca", predictionCol="cluster",
                            probabilityCol="_prob").fit(projection)
    return model.transform(projection).select("patient_id", F.col("cluster").cast("int"))


def streaming_kmeans_clusters(projection: DataFrame, k: int = K_CLUSTERS, seed: int = SEED,
                              weight: float = STREAM_CENTRE_WEIGHT, decay: float = STREAM_DECAY,
                              time_unit: str = STREAM_TIME_UNIT) -> DataFrame:
    """One mini-batch update from random centres over all points, then assignment."""
    points = projection.select("patient_id", vector_to_array("pca").alias("features"))
    dim = len(points.select("features").first()["features"])
    centres = random_centres(projection.sparkSession, k, dim, weight, seed)
    new_centres = update(points, centres, decay, time_unit)
    return assign(points, new_centres).select("patient_id", "cluster")


def evaluate(labels: DataFrame, space: FeatureSpace, feature_set: str) -> DataFrame:
    """Three purities for one feature set: ``(feature_set, algorithm, n_pairs, purity)``.

    The fits do not depend on each other and run side by side.
    """
    _, projection = fit_projection(space)
    runs = {"kmeans": kmeans_clusters, "gmm": gmm_clusters, "streaming_kmeans": streaming_kmeans_clusters}
    clusters = together(*[partial(fit, projection) for fit in runs.values()])
    rows = [
        purity(paired_by_patient(found, labels)).select(
            F.lit(feature_set).alias("feature_set"), F.lit(name).alias("algorithm"), "n_pairs", "purity")
        for name, found in zip(runs, clusters, strict=True)
    ]
    return reduce(DataFrame.unionByName, rows)


def purity_report(labels: DataFrame, tagged: DataFrame, allow_codes: Allow = None, allow_drugs: Allow = None,
                  allow_labs: Allow = None, case_insensitive: bool = False) -> DataFrame:
    """Six purities: k-means, GMM, streaming k-means on all and on allow-listed features.

    ``tagged`` are the domain-tagged tuples; they are written once and both
    arms read that table, side by side. The labels are joined six times, so they
    are written once too. The events are read twice in all: for the labels and the tuples.
    """
    labels = materialize_table(labels.select("patient_id", "label"), "labels")
    tagged = materialize_table(tagged, "tagged-tuples")
    arms = (("all", tagged.select("patient_id", "feature", "value")),
            ("filtered", allowed_tuples(tagged, allow_codes, allow_drugs, allow_labs, case_insensitive)))
    return reduce(DataFrame.unionByName, together(*[
        lambda name=name, tuples=tuples: evaluate(labels, build_feature_space(tuples, written=True), name)
        for name, tuples in arms]))
