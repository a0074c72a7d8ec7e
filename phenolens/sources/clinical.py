"""Typed clinical event tables built from the four raw health-record CSVs.

Schemas (one snake_case model everywhere):

* diagnostic: ``patient_id string, code string, date date``
* medication: ``patient_id string, date date, medicine string``
* lab:        ``patient_id string, date date, test_name string, value double``
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_date, parse_number
from .csv import read_csv_table

DIAGNOSTIC_COLUMNS = ("patient_id", "code", "date")
MEDICATION_COLUMNS = ("patient_id", "date", "medicine")
LAB_COLUMNS = ("patient_id", "date", "test_name", "value")

# --- fixed values: file names of the raw inputs inside a data folder ---
ENCOUNTER_FILE = "encounter_INPUT.csv"
ENCOUNTER_DX_FILE = "encounter_dx_INPUT.csv"
MEDICATION_FILE = "medication_orders_INPUT.csv"
LAB_FILE = "lab_results_INPUT.csv"


@dataclass(frozen=True)
class EventTables:
    """The three event tables every operator reads.

    ``visits`` may hold the diagnoses and drug orders of ``dx`` and ``med`` in
    one table, ``(patient_id, code, medicine, date)`` with a code or a
    medicine in each row; the labelling then reads their common source once.
    It is a function of another one, which gets a table with the name of its
    medicine column and adds a boolean column ``wanted``: so that only wanted
    orders reach the joins. ``events`` may hold all three as rows
    ``(patient_id, domain, name, date, value)``, the domain being dx, med or lab.
    """

    dx: DataFrame
    med: DataFrame
    lab: DataFrame
    visits: Callable[[Callable[[DataFrame, str], DataFrame]], DataFrame] | None = None
    events: DataFrame | None = None


def medication_events(encounter: DataFrame, med: DataFrame) -> DataFrame:
    """Drug orders joined to their encounter (inner join on ``Encounter_ID``).

    Rows without a patient are dropped here, so later anti joins never meet a
    null key.
    """
    return (
        encounter.select("Encounter_ID", "Member_ID")
        .join(med.select("Encounter_ID", "Order_Date", "Drug_Name"), "Encounter_ID")
        .select(
            F.col("Member_ID").cast("string").alias("patient_id"),
            parse_date("Order_Date").alias("date"),
            F.col("Drug_Name").cast("string").alias("medicine"),
        )
        .where(F.col("patient_id").isNotNull())
    )


def lab_events(lab: DataFrame) -> DataFrame:
    """Lab results; rows with any null or NaN field (bad number, bad date) are dropped."""
    return lab.select(
        F.col("Member_ID").cast("string").alias("patient_id"),
        parse_date("Date_Resulted").alias("date"),
        F.col("Result_Name").cast("string").alias("test_name"),
        parse_number("Numeric_Result").alias("value"),
    ).na.drop()


def diagnostic_events(encounter: DataFrame, encounter_dx: DataFrame) -> DataFrame:
    """Diagnosis codes joined to their encounter; date is the encounter date."""
    return (
        encounter.select("Encounter_ID", "Member_ID", "Encounter_DateTime")
        .join(encounter_dx.select("Encounter_ID", "Code_ID"), "Encounter_ID")
        .select(
            F.col("Member_ID").cast("string").alias("patient_id"),
            F.col("Code_ID").cast("string").alias("code"),
            parse_date("Encounter_DateTime").alias("date"),
        )
        .where(F.col("patient_id").isNotNull())
    )


def load_event_tables(spark: SparkSession, folder: str) -> EventTables:
    """Read the four raw CSVs in ``folder`` and build the three event tables."""
    encounter = read_csv_table(spark, os.path.join(folder, ENCOUNTER_FILE), "encounter")
    encounter_dx = read_csv_table(spark, os.path.join(folder, ENCOUNTER_DX_FILE), "encounter_dx")
    med = read_csv_table(spark, os.path.join(folder, MEDICATION_FILE), "med")
    lab = read_csv_table(spark, os.path.join(folder, LAB_FILE), "lab")
    return EventTables(
        dx=diagnostic_events(encounter, encounter_dx),
        med=medication_events(encounter, med),
        lab=lab_events(lab),
    )


def write_event_tables(tables: EventTables, folder: str, mode: str = "overwrite") -> None:
    """Persist the cleaned tables as Parquet, one folder each.

    Converting the raw CSVs once lets every later job read columnar files with
    pushdown instead of re-parsing and re-joining text.
    """
    tables.dx.write.mode(mode).parquet(os.path.join(folder, "diagnostic"))
    tables.med.write.mode(mode).parquet(os.path.join(folder, "medication"))
    tables.lab.write.mode(mode).parquet(os.path.join(folder, "lab"))


def read_event_tables(spark: SparkSession, folder: str) -> EventTables:
    """Read tables written by :func:`write_event_tables`."""
    return EventTables(
        dx=spark.read.parquet(os.path.join(folder, "diagnostic")),
        med=spark.read.parquet(os.path.join(folder, "medication")),
        lab=spark.read.parquet(os.path.join(folder, "lab")),
    )
