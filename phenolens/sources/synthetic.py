"""Clinical views over the driver's synthetic parquet tables.

Mapping (an order is an encounter, its customer the patient):

* diagnostic: line 1 of each order; code = ``p_brand || '.' || (p_size % 10)``,
  date = order date.
* medication: lines 2.. of each order; medicine = ``p_name``, date = ship date.
* lab: ``events``; test = ``event_type``, date = ``ts`` as a date.

Joins run on the numeric keys (cast to text afterwards), which is the same
match as joining the text forms and avoids casting billions of keys.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .clinical import ENCOUNTER_DX_FILE, ENCOUNTER_FILE, LAB_FILE, MEDICATION_FILE, EventTables


# Schemas already read, by local path and modification time: a repeated read
# passes the schema instead of launching a footer-reading job again.
_SCHEMAS: dict[tuple[str, float], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (path, os.path.getmtime(path)) if os.path.exists(path) else None
    if key in _SCHEMAS:
        return spark.read.schema(_SCHEMAS[key]).parquet(path)
    df = spark.read.parquet(path)
    if key is not None:
        _SCHEMAS[key] = df.schema
    return df


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a Structured Streaming file source.

    The file source watches folders; a one-character glob turns the single
    file into a pattern the source can list. New files matching it arrive
    as new micro-batches.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(path[:-1] + "[" + path[-1] + "]")


def encounter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines joined to their order and part: one row per line."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("encounter_date"),
    )
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
    )


def _dx(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("l_linenumber") == 1).select(
        "patient_id",
        F.concat(F.col("p_brand"), F.lit("."), (F.col("p_size") % 10).cast("string")).alias("code"),
        F.col("encounter_date").alias("date"),
    ).where(F.col("patient_id").isNotNull())


def _med(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("l_linenumber") > 1).select(
        "patient_id",
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("p_name").alias("medicine"),
    ).where(F.col("patient_id").isNotNull())


def _lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("patient_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("test_name"),
        F.col("value").cast("double").alias("value"),
    ).na.drop()


def synthetic_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dx(encounter_lines(spark, sf_dir))


def synthetic_medication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _med(encounter_lines(spark, sf_dir))


def synthetic_lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lab(spark, sf_dir)


def synthetic_visits(spark: SparkSession, sf_dir: str, mark: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Diagnoses and the drug orders whose medicine ``mark`` wants, from one scan of the lines.

    ``(patient_id, code, medicine, date)``; a row has a code (line 1 of an
    order) or a medicine (the other lines). The parts are marked before any
    join, and lines that are neither first nor of a marked part go in the join
    with the parts, below the join with the orders.
    """
    part = mark(table(spark, sf_dir, "part").select(
        "p_partkey", "p_name",
        F.concat(F.col("p_brand"), F.lit("."), (F.col("p_size") % 10).cast("string")).alias("p_code")), "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    first = F.col("l_linenumber") == 1
    kept = lines.join(part, (F.col("l_partkey") == F.col("p_partkey")) & (first | ((F.col("l_linenumber") > 1) & F.col("wanted"))))
    orders = table(spark, sf_dir, "orders").where(F.col("o_custkey").isNotNull()).select("o_orderkey", "o_custkey", "o_orderdate")
    return kept.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.when(first, F.col("p_code")).alias("code"),
        F.when(~first, F.col("p_name")).alias("medicine"),
        F.when(first, F.col("o_orderdate").cast("date")).otherwise(F.col("l_shipdate").cast("date")).alias("date"))


def synthetic_event_tables(spark: SparkSession, sf_dir: str) -> EventTables:
    lines = encounter_lines(spark, sf_dir)
    return EventTables(dx=_dx(lines), med=_med(lines), lab=_lab(spark, sf_dir),
                       visits=lambda mark: synthetic_visits(spark, sf_dir, mark))


ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def raw_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver tables as the four raw health-record inputs: ``encounter``, ``encounter_dx``, ``med`` and ``lab``, all text.

    Keys and numbers become text, dates become ISO date-times, lab values are
    printed in full.
    """
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return {
        "encounter": orders.select(
            F.col("o_orderkey").cast("string").alias("Encounter_ID"),
            F.col("o_custkey").cast("string").alias("Member_ID"),
            F.date_format("o_orderdate", ISO).alias("Encounter_DateTime")),
        "encounter_dx": lines.where(F.col("l_linenumber") == 1).select(
            F.col("l_orderkey").cast("string").alias("Encounter_ID"),
            F.concat(F.col("p_brand"), F.lit("."), (F.col("p_size") % 10).cast("string")).alias("Code_ID")),
        "med": lines.where(F.col("l_linenumber") > 1).select(
            F.col("l_orderkey").cast("string").alias("Encounter_ID"),
            F.date_format("l_shipdate", ISO).alias("Order_Date"),
            F.col("p_name").alias("Drug_Name")),
        "lab": table(spark, sf_dir, "events").select(
            F.col("user_id").cast("string").alias("Member_ID"),
            F.date_format("ts", ISO).alias("Date_Resulted"),
            F.col("event_type").alias("Result_Name"),
            F.col("value").cast("string").alias("Numeric_Result")),
    }


def write_raw_csvs(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """``raw_frames`` as header CSVs, which :func:`phenolens.sources.load_event_tables` turns back into the event tables."""
    names = {"encounter": ENCOUNTER_FILE, "encounter_dx": ENCOUNTER_DX_FILE, "med": MEDICATION_FILE, "lab": LAB_FILE}
    for kind, df in raw_frames(spark, sf_dir).items():
        df.write.mode("error").option("header", "true").csv(f"{folder.rstrip('/')}/{names[kind]}")
