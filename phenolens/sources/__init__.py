"""Sources (raw CSV, allow-lists, driver tables) and sinks."""

from .clinical import (
    EventTables,
    diagnostic_events,
    lab_events,
    load_event_tables,
    medication_events,
    read_event_tables,
    write_event_tables,
)
from .csv import infer_table_name, read_allow_list, read_csv_table
from .sinks import write_feature_tuples, write_labels
from .synthetic import (
    encounter_lines,
    synthetic_diagnostic,
    synthetic_event_tables,
    synthetic_lab,
    synthetic_medication,
)

__all__ = [
    "EventTables",
    "diagnostic_events",
    "encounter_lines",
    "infer_table_name",
    "lab_events",
    "load_event_tables",
    "medication_events",
    "read_allow_list",
    "read_csv_table",
    "read_event_tables",
    "synthetic_diagnostic",
    "synthetic_event_tables",
    "synthetic_lab",
    "synthetic_medication",
    "write_event_tables",
    "write_feature_tuples",
    "write_labels",
]
