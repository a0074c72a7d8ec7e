"""Raw text sources: header CSV tables and one-term-per-line allow-lists."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed value: the pattern of a table's name ---
# The table name is the last run of word characters, before an optional
# ".csv" suffix; a path that ends in anything else keeps its full text.
_TABLE_NAME = re.compile(r"(\w+)(\.csv)?$")


def infer_table_name(path: str) -> str:
    """``data/encounter_INPUT.csv`` -> ``encounter_INPUT``; ``x.txt`` -> ``txt``."""
    match = _TABLE_NAME.search(path)
    return match.group(1) if match else path


def read_csv_table(spark: SparkSession, path: str, table_name: str | None = None,
                   register: bool = True) -> DataFrame:
    """Header CSV, every column a string, malformed lines dropped.

    A line whose field count differs from the header is malformed and dropped
    whatever columns a later query selects: CSV column pruning is switched
    off for this reader, otherwise Spark would only check the selected
    columns. No schema is passed, because a partial schema binds by position,
    not by header name. The frame is registered as a temp view under
    ``table_name`` (inferred from the path when omitted).
    """
    df = (
        spark.read.option("header", "true")
        .option("mode", "DROPMALFORMED")
        .option("sep", ",")
        .option("columnPruning", "false")
        .csv(path)
    )
    if register:
        df.createOrReplaceTempView(table_name or infer_table_name(path))
    return df


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    """One term per line, lower-cased and de-duplicated: ``(term string)``."""
    return spark.read.text(path).select(F.lower("value").alias("term")).distinct()
