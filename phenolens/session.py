"""Session helpers.

Library functions never build or configure a session: they take the caller's
``SparkSession`` and return lazy DataFrames. The builder below is for tests,
the bench and ``__spark_entry__`` smoke runs on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "phenolens", extra: dict | None = None) -> SparkSession:
    """Local session with AQE on and the web UI off.

    A checkpoint folder is only invented here, for local runs; on a cluster
    ``spark.checkpoint.dir`` must name a shared folder (see
    :func:`checkpoint_dir`).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PHENOLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    # A new local session has no checkpoint folder yet: give it its own.
    builder = builder.config(
        "spark.checkpoint.dir", tempfile.mkdtemp(prefix="phenolens-ckpt-", dir="/tmp"))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder that ``DataFrame.checkpoint`` writes to.

    Order: the folder already set on the context, then the session's
    ``spark.checkpoint.dir``; a local master without either gets a fresh
    temporary folder (single machine, so local disk is shared by all
    executors). A cluster without a shared folder is an error rather than a
    silent machine-local write.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset static conf raises on some versions
            conf = None
    if conf:
        sc.setCheckpointDir(conf)
        return conf
    if sc.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="phenolens-ckpt-", dir="/tmp")
        sc.setCheckpointDir(local)
        return local
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a folder every executor can reach")


def written_path(df: DataFrame, label: str) -> str:
    """Write ``df`` as Parquet to a fresh folder under the checkpoint folder; the folder."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/phenolens-{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` but computes the input once
    (a reliable RDD checkpoint runs its input a second time to write it), and
    the result is a columnar table with exact sizes for AQE and pushdown for
    later filters. The folder name is unique per call.
    """
    return df.sparkSession.read.parquet(written_path(df, label))


def together(*calls: Callable[[], T]) -> list[T]:
    """Results of the calls, whose Spark jobs run side by side: stages of few tasks leave cores to the others'."""
    with ThreadPoolExecutor(len(calls)) as pool:
        return [run.result() for run in [pool.submit(inheritable_thread_target(call)) for call in calls]]
