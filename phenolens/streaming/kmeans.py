"""Mini-batch (streaming) k-means as DataFrame operations.

Update rule for one batch with per-cluster point count ``m`` and point sum ``s``:

* ``discount = decay`` (time unit "batches") or ``decay ** n_batch_points``
  (time unit "points");
* ``W = weight * discount + m``; ``lambda = m / max(W, 1e-16)``;
* ``centre = (1 - lambda) * centre + (lambda / m) * s`` (clusters without
  points keep their centre); the weight becomes ``W``;
* dying cluster: when ``min(W) < 1e-8 * max(W)`` the smallest and largest
  both take weight ``(max + min) / 2``, and the largest centre ``x`` is split
  into ``x + p`` (largest) and ``x - p`` (smallest), ``p = 1e-14 * max(|x|, 1)``
  per coordinate.

Few centres travel into the plan as array literals, so the nearest centre is
a per-row expression (no join, no shuffle). More than ``LITERAL_VALUES``
coordinates in all are broadcast as one block instead, and an Arrow function
measures a batch of points against it: the plan does not grow with k, and the
distances are added up in the same order, so both ways give the same bits.
The batch statistics are one ``groupBy(cluster)`` with partial aggregation;
the update itself runs over the k-row centre table. Only the k centres (model state, bounded by k) are
read on the driver, to become the next batch's literals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Coordinates of all centres together that go into the plan as literals.
LITERAL_VALUES = 1024
#: Distances (points x centres) that a task holds at a time.
BLOCK_DISTANCES = 1 << 20

CENTRE_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("weight", T.DoubleType(), False),
    T.StructField("center", T.ArrayType(T.DoubleType(), False), False),
])


def centres_frame(spark: SparkSession, centres: Sequence[Sequence[float]],
                  weights: Sequence[float] | float) -> DataFrame:
    """``(cluster, weight, center)`` from given centres."""
    k = len(centres)
    if isinstance(weights, (int, float)):
        weights = [float(weights)] * k
    rows = [(i, float(w), [float(x) for x in c]) for i, (c, w) in enumerate(zip(centres, weights))]
    return spark.createDataFrame(rows, CENTRE_SCHEMA)


def random_centres(spark: SparkSession, k: int, dim: int, weight: float, seed: int) -> DataFrame:
    """k centres drawn from a standard normal, each with the given weight."""
    rng = np.random.default_rng(seed)
    return centres_frame(spark, rng.standard_normal((k, dim)).tolist(), weight)


def _sq_distance(features: Column, centre: Sequence[float]) -> Column:
    lit_centre = F.array(*[F.lit(float(x)) for x in centre])
    diffs = F.zip_with(features, lit_centre, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def nearest_centre(features: Column, centres: Sequence[Sequence[float]]) -> Column:
    """0-based index of the nearest centre (squared Euclidean; ties -> lowest index).

    Null for features that are null, hold a null or have another length: no distance is known.
    """
    dists = F.array(*[_sq_distance(features, c) for c in centres])
    known = (F.size(features) == F.lit(len(centres[0]))) & ~F.exists(features, lambda x: x.isNull())
    return F.when(known, F.array_position(dists, F.array_min(dists)) - F.lit(1)).cast("int")


def _local_centres(centres: DataFrame) -> list[tuple[int, float, list[float]]]:
    rows = centres.orderBy("cluster").collect()  # k rows of model state
    return [(r["cluster"], r["weight"], list(r["center"])) for r in rows]


def nearest_rows(features: pa.Array, centres: np.ndarray) -> np.ndarray:
    """Index of the centre nearest to each row of a list array; -1 for rows that are null, hold a null or have another length."""
    dim = centres.shape[1]
    offs = features.offsets.to_numpy()
    values = features.values
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    nulls = np.concatenate(([0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))))
    good = features.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offs) == dim) & (nulls[offs[1:]] == nulls[offs[:-1]])
    rows, out = np.flatnonzero(good), np.full(len(features), -1, np.int64)
    step = max(1, BLOCK_DISTANCES // len(centres))
    for at in range(0, len(rows), step):
        part = rows[at:at + step]
        block = x[offs[part][:, None] + np.arange(dim)]
        total = np.zeros((len(part), len(centres)))
        for d in range(dim):  # one coordinate after the other, as the literal form adds them
            diff = block[:, d, None] - centres[:, d]
            total += diff * diff
        out[part] = np.where(np.isnan(total), np.inf, total).argmin(1)
    return out


def _assign_block(points: DataFrame, local: list[tuple[int, float, list[float]]], features_col: str) -> DataFrame:
    """``assign`` with the centres broadcast as one block of k x dim numbers."""
    block = points.sparkSession.sparkContext.broadcast(
        (np.array([c[0] for c in local], np.int32), np.array([c[2] for c in local], np.float64)))

    @F.arrow_udf("int")
    def nearest(features: pa.Array) -> pa.Array:
        ids, centres = block.value
        found = nearest_rows(features, centres)
        return pa.array(ids[found], mask=found < 0)

    return points.withColumn("cluster", nearest(F.col(features_col).cast("array<double>")))


def assign(points: DataFrame, centres: DataFrame, features_col: str = "features") -> DataFrame:
    """Add ``cluster`` (id of the nearest centre; ties: the smallest id) to every point."""
    local = _local_centres(centres)
    if sum(len(c[2]) for c in local) > LITERAL_VALUES:
        return _assign_block(points, local, features_col)
    pos = nearest_centre(F.col(features_col), [c[2] for c in local])
    ids = F.array(*[F.lit(c[0]) for c in local])
    return points.withColumn("cluster", F.when(pos.isNotNull(), F.get(ids, pos)))


def batch_statistics(assigned: DataFrame, dim: int, features_col: str = "features") -> DataFrame:
    """``(cluster, m, sums array<double>)`` per cluster of one batch."""
    aggs = [F.sum(F.col(features_col)[d]).alias(f"_s{d}") for d in range(dim)]
    stats = assigned.groupBy("cluster").agg(F.count(F.lit(1)).cast("double").alias("m"), *aggs)
    return stats.select("cluster", "m", F.array(*[F.col(f"_s{d}") for d in range(dim)]).alias("sums"))


def update_centres(centres: DataFrame, stats: DataFrame, decay: float = 1.0,
                   time_unit: str = "batches") -> DataFrame:
    """Apply one mini-batch update to the k-row centre table."""
    if time_unit not in ("batches", "points"):
        raise ValueError("time_unit must be 'batches' or 'points'")
    everyone = Window.partitionBy()  # the k-row centre table only
    joined = centres.join(stats, "cluster", "left").withColumn("m", F.coalesce("m", F.lit(0.0)))
    if time_unit == "batches":
        discount = F.lit(float(decay))
    else:
        discount = F.pow(F.lit(float(decay)), F.sum("m").over(everyone))
    # New names for every derived column: re-using "weight" inside the same
    # select would bind later expressions to the new value.
    lam = F.col("m") / F.greatest(F.col("_w"), F.lit(1e-16))
    moved = F.when(
        F.col("m") > 0,
        F.zip_with("center", "sums", lambda c, s: (F.lit(1.0) - lam) * c + (lam / F.col("m")) * s),
    ).otherwise(F.col("center"))
    step = (
        joined.withColumn("_w", F.col("weight") * discount + F.col("m"))
        .select("cluster", F.col("_w").alias("weight"), moved.alias("center"))
    )
    # Dying-cluster split, decided over the k rows.
    with_ext = (
        step.withColumn("_max", F.max("weight").over(everyone))
        .withColumn("_min", F.min("weight").over(everyone))
        .withColumn("_largest", F.min(F.when(F.col("weight") == F.col("_max"), F.col("cluster"))).over(everyone))
        .withColumn("_smallest", F.min(F.when(F.col("weight") == F.col("_min"), F.col("cluster"))).over(everyone))
        .withColumn("_largest_center", F.first(
            F.when(F.col("cluster") == F.col("_largest"), F.col("center")), ignorenulls=True).over(everyone))
    )
    dying = F.col("_min") < F.lit(1e-8) * F.col("_max")
    split_w = (F.col("_max") + F.col("_min")) / F.lit(2.0)

    def shifted(sign: float) -> Column:
        return F.transform(
            "_largest_center",
            lambda x: x + F.lit(sign) * F.lit(1e-14) * F.greatest(F.abs(x), F.lit(1.0)))

    is_l = F.col("cluster") == F.col("_largest")
    is_s = F.col("cluster") == F.col("_smallest")
    return with_ext.select(
        "cluster",
        F.when(dying & (is_l | is_s), split_w).otherwise(F.col("weight")).alias("weight"),
        F.when(dying & is_l, shifted(1.0))
        .when(dying & is_s, shifted(-1.0))
        .otherwise(F.col("center")).alias("center"),
    )


def update(points: DataFrame, centres: DataFrame, decay: float = 1.0, time_unit: str = "batches",
           features_col: str = "features") -> DataFrame:
    """One mini-batch: assign, aggregate, update. Returns the new centre table."""
    dim = len(centres.select("center").first()["center"])
    stats = batch_statistics(assign(points, centres, features_col), dim, features_col)
    return update_centres(centres, stats, decay, time_unit)


def centres_long(centres: DataFrame) -> DataFrame:
    """``(cluster, weight, dim, center)``: one row per centre coordinate."""
    return centres.select("cluster", "weight", F.posexplode("center").alias("dim", "center"))


class StreamingKMeans:
    """Mini-batch k-means driven by Structured Streaming's ``foreachBatch``.

    The centre table is a Parquet table partitioned by ``batch``: the initial
    centres are ``batch=-1`` and batch ``b`` writes ``batch=b`` (dynamic
    partition overwrite). Batch ``b`` starts from the newest state below
    ``b``, so a batch replayed after a failure recomputes the same centres.
    Once batch ``b`` is written, states older than the one it started from are
    deleted, but for the initial one, so the folder holds three states however long the stream runs; a
    table that ``latest`` gave is good until two more batches have run.
    ``state_dir`` must be a folder the driver and every executor can reach.
    """

    def __init__(self, state_dir: str, initial: DataFrame, decay: float = 1.0,
                 time_unit: str = "batches", features_col: str = "features") -> None:
        self.state_dir = state_dir.rstrip("/")
        self.decay = decay
        self.time_unit = time_unit
        self.features_col = features_col
        self._write(initial, -1)

    def _write(self, centres: DataFrame, batch_id: int) -> None:
        (
            centres.select("cluster", "weight", "center")
            .withColumn("batch", F.lit(batch_id))
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(self.state_dir)
        )

    def latest(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Centre table of the newest committed batch (below ``before`` if given)."""
        state = spark.read.parquet(self.state_dir)
        if before is not None:
            state = state.where(F.col("batch") < before)
        newest = state.agg(F.max("batch")).first()[0]
        return state.where(F.col("batch") == newest).select("cluster", "weight", "center")

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` callback: one update from the previous state."""
        start = self.latest(batch.sparkSession, before=batch_id)
        self._write(update(batch, start, self.decay, self.time_unit, self.features_col), batch_id)
        self._forget(batch.sparkSession, batch_id)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the states before the one that batch ``batch_id`` started from, but for the initial one."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.state_dir)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        paths = {int(p.getName().removeprefix("batch=")): p for p in (f.getPath() for f in files.listStatus(folder))
                 if p.getName().startswith("batch=")}
        start = max((b for b in paths if b < batch_id), default=batch_id)
        for b, path in paths.items():
            if 0 <= b < start:
                files.delete(path, True)

    def predict(self, points: DataFrame) -> DataFrame:
        return assign(points, self.latest(points.sparkSession), self.features_col)


def run_stream(points: DataFrame, model: StreamingKMeans, checkpoint_location: str,
               timeout_s: float | None = None) -> DataFrame:
    """Feed a streaming DataFrame of points through ``model`` until the
    available input is consumed (``availableNow``); return the latest centres.

    ``checkpoint_location`` holds the stream's offsets, so a restarted query
    resumes after the last committed micro-batch.
    """
    query = (
        points.writeStream.foreachBatch(model.process_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    done = query.awaitTermination(timeout_s)
    if done is False:
        query.stop()
        raise TimeoutError(f"the stream was not consumed within {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()
    return model.latest(points.sparkSession)
