"""The whole study from raw files: labels, both feature arms, six purities.

Inputs, as the original application reads them: a folder with the four raw
health-record CSVs and, optionally, a folder with the allow-lists
``med_filter.txt``, ``lab_filter.txt`` and ``icd9_filter.txt`` (one term per
line, lower-cased on load).

    python -m phenolens.plans.study RAW_FOLDER [ALLOW_FOLDER] [--out OUT] [--rules diabetes|synthetic]

prints the six purities with five decimals and, with ``--out``, writes the
labels and the feature tuples as tab-separated text.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort, features
from ..rules import DIABETES_RULES, SYNTHETIC_RULES, CohortRules
from ..sources import load_event_tables, read_allow_list, write_feature_tuples, write_labels
from ..sources.clinical import EventTables
from ..sources.store import write_event_store
from . import clustering

RULE_SETS = {"diabetes": DIABETES_RULES, "synthetic": SYNTHETIC_RULES}
ALLOW_FILES = {"drugs": "med_filter.txt", "labs": "lab_filter.txt", "codes": "icd9_filter.txt"}


@dataclass
class Study:
    tables: EventTables
    labels: DataFrame
    tuples_all: DataFrame
    tuples_filtered: DataFrame
    report: DataFrame


def load_allow_lists(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three allow-lists as one-column ``(term)`` DataFrames."""
    return {kind: read_allow_list(spark, os.path.join(folder, name)) for kind, name in ALLOW_FILES.items()}


def run_study(spark: SparkSession, raw_folder: str, allow_folder: str | None = None,
              rules: CohortRules = DIABETES_RULES, case_insensitive: bool = False, buckets: int = 64) -> Study:
    """Labels, feature tuples (all and allow-listed) and the purity report.

    Each raw CSV is parsed once, into an event store bucketed by patient; the
    report writes the labels and the domain-tagged tuples once from it, and both
    arms read those tuples. Without ``allow_folder`` the filtered arm keeps no
    tuples and its report rows are absent. The models are fitted by the call;
    the report's rows are computed when it is read.
    """
    tables = write_event_store(load_event_tables(spark, raw_folder), buckets=buckets).tables(spark)
    labels = cohort.phenotype(tables, rules)
    tagged = features.tagged_tuples(tables)
    tuples_all = tagged.select("patient_id", "feature", "value")
    if allow_folder is None:
        report = clustering.evaluate(labels, clustering.build_feature_space(tuples_all), "all")
        tuples_filtered = tuples_all.where(F.lit(False))
    else:
        terms = load_allow_lists(spark, allow_folder)
        allow = {f"allow_{kind}": terms[kind] for kind in ("codes", "drugs", "labs")}
        tuples_filtered = features.allowed_tuples(tagged, **allow, case_insensitive=case_insensitive)
        report = clustering.purity_report(labels, tagged, **allow, case_insensitive=case_insensitive)
    return Study(tables, labels, tuples_all, tuples_filtered, report)


def format_report(report: DataFrame) -> DataFrame:
    """``purity`` as text with five decimals, for display."""
    return report.select("feature_set", "algorithm", "n_pairs",
                         F.format_string("%.5f", "purity").alias("purity"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("raw_folder")
    parser.add_argument("allow_folder", nargs="?")
    parser.add_argument("--out", help="folder for labels/ and feature_tuples/ (tab-separated)")
    parser.add_argument("--rules", choices=sorted(RULE_SETS), default="diabetes")
    args = parser.parse_args(argv)
    spark = (SparkSession.builder.appName("phenolens-study")
             .config("spark.ui.enabled", "false").getOrCreate())
    study = run_study(spark, args.raw_folder, args.allow_folder, RULE_SETS[args.rules])
    if args.out:
        write_labels(study.labels, os.path.join(args.out, "labels"))
        write_feature_tuples(study.tuples_all, os.path.join(args.out, "feature_tuples"), fmt="tsv")
    format_report(study.report).show(truncate=False)


if __name__ == "__main__":
    main()
