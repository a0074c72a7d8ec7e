"""An event store: all events in one table, bucketed by patient and tagged by domain.

The raw files are read once. Diagnoses, drug orders and lab results become rows
``(patient_id, domain, name, date, value)`` of one table that is bucketed by
patient and sorted by patient and domain within each bucket, so whatever is
grouped by patient afterwards (labels, tuples, vectors) reads its rows where
they lie, without an exchange on the patient. The three event tables are
filters on the domain, which reach the scan.

The number of buckets should follow the size; :func:`buckets_for` takes it from
a row count. A patient's rows lie in one bucket, as any grouping by patient
needs; a bucket is read in one task, so a patient with a large share of all
rows makes one long task of partial sums, not a large shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .clinical import EventTables

#: Rows of one bucket (about 40 bytes each).
ROWS_PER_BUCKET = 5_000_000
NAMES = {"dx": "code", "med": "medicine", "lab": "test_name"}


def buckets_for(rows: int, least: int = 8) -> int:
    return max(least, -(-rows // ROWS_PER_BUCKET))


def tagged_events(tables: EventTables) -> DataFrame:
    """``(patient_id, domain, name, date, value)`` of the three event tables; rows without a patient are no events."""
    parts = [getattr(tables, domain).select(
        "patient_id", F.lit(domain).alias("domain"), F.col(name).alias("name"), "date",
        (F.col("value") if domain == "lab" else F.lit(None).cast("double")).alias("value")) for domain, name in NAMES.items()]
    return reduce(DataFrame.unionByName, parts).where(F.col("patient_id").isNotNull())


@dataclass(frozen=True)
class EventStore:
    """The bucketed table's name in the session's catalog."""

    name: str
    buckets: int

    def tables(self, spark: SparkSession) -> EventTables:
        events = spark.table(self.name)

        def of(domain: str, *columns: str) -> DataFrame:
            named = {NAMES[domain]: F.col("name")}
            return events.where(F.col("domain") == domain).select(*[named.get(c, F.col(c)).alias(c) for c in columns])

        return EventTables(dx=of("dx", "patient_id", "code", "date"), med=of("med", "patient_id", "date", "medicine"),
                           lab=of("lab", "patient_id", "date", "test_name", "value"), events=events)


def write_event_store(tables: EventTables, folder: str | None = None, buckets: int = 64, name: str | None = None) -> EventStore:
    """Write the events bucketed by patient to ``folder`` (default: a fresh one under the checkpoint folder)."""
    events = tagged_events(tables)
    name = name or f"phenolens_events_{uuid.uuid4().hex}"
    path = folder or f"{checkpoint_dir(events.sparkSession).rstrip('/')}/{name}"
    # Dealt by the bucket's own hash first: each bucket is one file, whatever the number of tasks.
    (events.repartition(buckets, "patient_id").write.mode("error").bucketBy(buckets, "patient_id")
     .sortBy("patient_id", "domain").option("path", path).saveAsTable(name))
    return EventStore(name, buckets)
