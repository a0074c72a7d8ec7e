"""The training-text pipeline: quality rules, near-dedup, substring dedup, PII, packing.

``STAGES`` lists the stages as (name, function); every function takes
(spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``; the last returns the packed pieces of the documents
that are left.

Cases: an empty table passes through every stage as an empty table; a null
text is rejected by the first stage (it has no words); columns besides those
of ``documents`` are dropped by the first stage; rows that repeat a
``doc_id`` are kept apart by the operators, see their docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.llm import near_dedup, packing, pii, quality, substring_dedup
from phenolens.llm.common import documents, scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.with_verdict(docs, model).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    losers = near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks that an earlier place has too."""
    return substring_dedup.cut_repeats(docs).select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in angle brackets."""
    return pii.redact(docs, pii.fit(docs)).select(*COLUMNS)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins."""
    return packing.best_fit(docs, packing.text_cluster(F.col("text")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("pii", private_data),
    ("best_fit_packing", best_fit),
]

#: The sketches, the model and the packing have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:  # what a stage wrote for itself goes when its result is written
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
