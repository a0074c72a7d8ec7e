"""Cohort rules read from a table."""

import pytest
from helpers import as_dict, tables

from phenolens.operators import cohort, rule_table
from phenolens.rules import DIABETES_RULES, SYNTHETIC_RULES
from phenolens.sources import synthetic_event_tables

SF = "/root/testdata/sf0.001"


def test_round_trip_of_the_default_rules(spark):
    got = rule_table.compile_rules(rule_table.as_rule_table(spark, DIABETES_RULES)).inline
    for name in (*rule_table.CODE_LISTS, *rule_table.DRUG_LISTS, "related_contains"):
        assert set(getattr(got, name)) == set(getattr(DIABETES_RULES, name))
    assert set(got.abnormal_labs) == set(DIABETES_RULES.abnormal_labs)
    assert (got.lab_marker, got.stat_test, got.exclusion) == ("glucose", "glucose", "row")


@pytest.mark.parametrize("inline_terms", [0, 1000])
@pytest.mark.parametrize("mode", ["row", "patient"])
def test_labels_of_compiled_rules_equal_those_of_given_ones(spark, mode, inline_terms):
    rules = SYNTHETIC_RULES.with_exclusion(mode)
    t = synthetic_event_tables(spark, SF)
    compiled = rule_table.compile_rules(rule_table.as_rule_table(spark, rules), inline_terms)
    assert as_dict(cohort.phenotype(t, compiled)) == as_dict(cohort.phenotype(t, rules)) != {}
    got = sorted(tuple(r) for r in cohort.label_stat(t, compiled).collect())
    assert got == sorted(tuple(r) for r in cohort.label_stat(t, rules).collect())


@pytest.mark.parametrize("inline_terms", [0, 1000])
def test_odd_rows_under_long_and_short_lists(spark, inline_terms):
    t = tables(spark,
               dx=[("p1", "250.02", "2010-01-01"), ("p2", "250.02", "2010-01-01"), ("p3", None, "2010-01-01"), (None, "250.02", "2010-01-01")],
               med=[("p1", "2010-01-02", "Lantus"), ("p1", "2010-01-01", "METFORMIN"), ("p2", "2010-01-01", None), ("p2", "2010-01-01", "aspirin")],
               lab=[("p4", "2010-01-01", "Glucose", 100.0), ("p5", "2010-01-01", "hba1c", 5.0)])
    rules = rule_table.compile_rules(rule_table.as_rule_table(spark, DIABETES_RULES), inline_terms)
    assert as_dict(cohort.phenotype(t, rules)) == {"p1": 1, "p2": 1, "p3": 3, "p4": 2}
    assert as_dict(cohort.case_branches(t, rules), value="branch") == {"p1": 3, "p2": 1}


def test_nulls_repeats_and_missing_lists(spark):
    rows = [("target_dx", "A", None, None), ("target_dx", "A", None, None), ("target_dx", None, None, None), ("lab_marker", "glucose", None, None)]
    rules = rule_table.compile_rules(spark.createDataFrame(rows, rule_table.RULE_SCHEMA))
    assert rules.inline.target_dx == ("A",) and rules.inline.target_drugs == () and rules.long == {}
    t = tables(spark, dx=[("p1", "A", "2010-01-01"), ("p2", "B", "2010-01-01")], med=[("p1", "2010-01-01", "lantus")])
    assert as_dict(cohort.phenotype(t, rules)) == {"p1": 1, "p2": 3}


@pytest.mark.parametrize("rows", [
    [("no such rule", "x", None, None), ("lab_marker", "g", None, None)],
    [("lab_marker", "a", None, None), ("lab_marker", "b", None, None)],
    [("target_dx", "A", None, None)],
    [("abnormal_labs", "a", "!", 1.0), ("lab_marker", "g", None, None)],
])
def test_bad_tables_are_refused(spark, rows):
    with pytest.raises(ValueError):
        rule_table.compile_rules(spark.createDataFrame(rows, rule_table.RULE_SCHEMA))
