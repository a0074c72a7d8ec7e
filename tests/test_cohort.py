"""Phenotype rules on hand-made rows (default diabetes rule set) and on the driver tables."""

import pytest

from helpers import as_dict, tables
from phenolens.operators import cohort
from phenolens.rules import DIABETES_RULES, SYNTHETIC_RULES
from phenolens.sources import synthetic_event_tables

T2 = "250.02"  # target code
T1 = "250.01"  # excluding code


def labels(spark, rules=DIABETES_RULES, **rows):
    return as_dict(cohort.phenotype(tables(spark, **rows), rules))


def branches(spark, rules=DIABETES_RULES, **rows):
    return as_dict(cohort.case_branches(tables(spark, **rows), rules), value="branch")


def test_case_branch_1_no_drug_rows(spark):
    assert branches(spark, dx=[("p", T2, "2010-01-01")]) == {"p": 1}


def test_case_branch_2_excluding_drug_only(spark):
    rows = dict(dx=[("p", T2, "2010-01-01")], med=[("p", "2010-01-02", "lantus")])
    assert branches(spark, **rows) == {"p": 2}


def test_case_branch_3_target_first(spark):
    rows = dict(dx=[("p", T2, "2010-01-01")],
                med=[("p", "2010-01-02", "metformin"), ("p", "2010-01-03", "lantus")])
    assert branches(spark, **rows) == {"p": 3}


def test_both_drugs_same_day_is_other(spark):
    rows = dict(dx=[("p", T2, "2010-01-01")],
                med=[("p", "2010-01-02", "metformin"), ("p", "2010-01-02", "lantus")])
    assert branches(spark, **rows) == {}
    assert labels(spark, **rows) == {"p": 3}


def test_null_excluding_date_is_other(spark):
    rows = dict(dx=[("p", T2, "2010-01-01")],
                med=[("p", "2010-01-02", "metformin"), ("p", None, "lantus")])
    assert labels(spark, **rows) == {"p": 3}


def test_target_and_excluding_dx_row_vs_patient_mode(spark):
    rows = dict(dx=[("p", T2, "2010-01-01"), ("p", T1, "2010-01-02")])
    assert labels(spark, **rows) == {"p": 1}
    assert labels(spark, DIABETES_RULES.with_exclusion("patient"), **rows) == {"p": 3}


def test_drug_name_case_and_spacing(spark):
    upper = dict(dx=[("p", T2, "2010-01-01")], med=[("p", "2010-01-02", "LANTUS")])
    assert branches(spark, **upper) == {"p": 2}
    spaced = dict(dx=[("p", T2, "2010-01-01")], med=[("p", "2010-01-02", " lantus")])
    assert branches(spark, **spaced) == {"p": 1}
    # "glucatrol " (trailing space) is in the list as given and never equals a trimmed name.
    trimmed = dict(dx=[("p", T2, "2010-01-01")],
                   med=[("p", "2010-01-02", "lantus"), ("p", "2010-01-01", "glucatrol")])
    assert branches(spark, **trimmed) == {"p": 2}


def test_glucose_110_is_normal_fasting_110_abnormal(spark):
    assert labels(spark, lab=[("p", "2010-01-01", "Glucose", 110.0)]) == {"p": 2}
    assert labels(spark, lab=[("p", "2010-01-01", "glucose", 110.5)]) == {}
    assert labels(spark, lab=[("p", "2010-01-01", "fasting glucose", 110.0)]) == {}


def test_hba1c_without_glucose_is_not_control(spark):
    assert labels(spark, lab=[("p", "2010-01-01", "hba1c", 5.0)]) == {}


def test_control_without_dx_and_labs_only_abnormal(spark):
    rows = dict(lab=[("c", "2010-01-01", "glucose", 90.0), ("a", "2010-01-01", "glucose", 300.0)])
    assert labels(spark, **rows) == {"c": 2}


def test_related_code_stem_mid_word(spark):
    rows = dict(dx=[("p", "X250.99", "2010-01-01")], lab=[("p", "2010-01-01", "glucose", 90.0)])
    assert labels(spark, **rows) == {"p": 3}
    related = as_dict(cohort.dx_related_patients(tables(spark, **rows).dx, DIABETES_RULES).selectExpr(
        "patient_id", "1 AS label"))
    assert related == {"p": 1}


def test_null_patient_does_not_empty_controls(spark):
    rows = dict(dx=[(None, "790.21", "2010-01-01"), ("o", "401.9", "2010-01-01")],
                lab=[("c", "2010-01-01", "glucose", 90.0)])
    # The builders drop null patients; even if one slips through, controls survive.
    got = labels(spark, **rows)
    assert got["c"] == 2 and got["o"] == 3


def test_one_label_per_patient_and_labels_partition(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    lab = cohort.phenotype(t, SYNTHETIC_RULES)
    assert lab.count() == lab.select("patient_id").distinct().count()
    assert {r[0] for r in lab.select("label").distinct().collect()} == {1, 2, 3}


@pytest.mark.parametrize("mode,expected", [
    ("row", {1: 25, 2: 9, 3: 114}),
    ("patient", {1: 22, 2: 9, 3: 117}),
])
def test_label_counts_sf0001(spark, mode, expected):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    counts = cohort.label_counts(cohort.phenotype(t, SYNTHETIC_RULES.with_exclusion(mode)))
    assert as_dict(counts, "label", "n_patients") == expected


def test_case_branch_counts_sf001(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.01")
    b = cohort.case_branches(t, SYNTHETIC_RULES).groupBy("branch").count()
    assert as_dict(b, "branch", "count") == {1: 84, 2: 30, 3: 109}


def test_label_column_needs_one_shuffle(spark):
    t = synthetic_event_tables(spark, "/root/testdata/sf0.001")
    plan = cohort.phenotype(t, SYNTHETIC_RULES)._jdf.queryExecution().executedPlan().toString()
    # One exchange on patient_id for the flags; the rest are the view joins.
    assert plan.count("hashpartitioning(patient_id") == 1
