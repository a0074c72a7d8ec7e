"""Rule-based phenotyping: case (1), control (2), other (3) per patient.

Plan shape: rows that no rule can use (drugs outside the lists, tests that are
neither marker nor abnormal) are filtered out first, below the encounter
joins. Then each event table is projected to ``(patient_id, flag columns)``,
the projections are unioned and folded by ONE ``groupBy("patient_id")``. Rules
may come as :class:`CohortRules` or from a table (``rule_table``).
Spark aggregates partially before the shuffle, so a patient that owns a large
share of all rows still sends only one row per map task; there is no collect,
no ``isin`` over collected ids and no chain of joins.

Case branches (a patient with a target diagnosis row):

1. no excluding-drug order;
2. an excluding drug and no target drug;
3. both, and the first target-drug date is strictly before the first
   excluding-drug date (a null first date never qualifies).

Control: has the marker lab test, no abnormal lab row and no related
diagnosis. Other: any remaining patient with a diagnosis row. Patients with
only labs or drugs who are not controls get no label. A patient who matches
case and control rules is a case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import abnormal_lab, contains_any, in_set
from ..rules import CohortRules
from ..sources.clinical import EventTables
from .rule_table import CODE_LISTS, DRUG_LISTS, CompiledRules, compiled, drug_terms

Rules = CohortRules | CompiledRules

CASE, CONTROL, OTHER = 1, 2, 3


# --- per-row flags ------------------------------------------------------------

def _related_code(code: Column, rules: CohortRules) -> Column:
    return in_set(code, rules.related_dx) | contains_any(code, rules.related_contains)


def _marker(test_name: Column, rules: CohortRules) -> Column:
    return F.lower(test_name).contains(rules.lab_marker.lower())


def _with_lists(rows: DataFrame, name: Column, rules: CompiledRules, lists: tuple[str, ...], lower: bool) -> DataFrame:
    """``rows`` with one boolean column for each of ``lists``: whether the name is in it (null counts as no)."""
    key = F.lower(name) if lower else name
    inline = {n: F.coalesce(in_set(key, getattr(rules.inline, n)), F.lit(False)) for n in lists}
    terms = rules.flags_of_terms(lists)
    if terms is None:
        return rows.withColumns({f"_in_{n}": c for n, c in inline.items()})
    terms = rules.bounded(terms.withColumnsRenamed({n: f"_long_{n}" for n in lists}), lists)
    joined = rows.join(terms, key == F.col("term"), "left")
    return joined.withColumns({f"_in_{n}": c | F.coalesce(F.col(f"_long_{n}"), F.lit(False)) for n, c in inline.items()})


def _wanted_drugs(med: DataFrame, rules: CompiledRules) -> DataFrame:
    """The drug orders whose drug is in a list: a pushed predicate, or a left semi join that Catalyst moves down."""
    name = F.lower(F.col("medicine"))
    if not any(n in rules.long for n in DRUG_LISTS):
        return med.where(in_set(name, drug_terms(rules)))
    inline = med.sparkSession.createDataFrame([(t,) for t in drug_terms(rules)], "term string")
    terms = inline.unionByName(rules.flags_of_terms(DRUG_LISTS).select("term"))
    return med.join(rules.bounded(terms, DRUG_LISTS), name == F.col("term"), "left_semi")


def _dx_flags(rules: CompiledRules) -> list[Column]:
    stem = F.coalesce(contains_any(F.col("code"), rules.inline.related_contains), F.lit(False))
    return [
        (F.col("_in_target_dx") & ~F.col("_in_excluding_dx")).alias("dx_target_row"),
        F.col("_in_target_dx").alias("dx_target_any"),
        F.col("_in_excluding_dx").alias("dx_excluding"),
        (F.col("_in_related_dx") | stem).alias("dx_related"),
    ]


def _med_flags() -> list[Column]:
    excluding, target = F.col("_in_excluding_drugs"), F.col("_in_target_drugs")
    return [
        excluding.alias("med_excluding"),
        target.alias("med_target"),
        F.when(excluding, F.col("date")).alias("excluding_date"),
        F.when(target, F.col("date")).alias("target_date"),
    ]


def visit_row_flags(visits: DataFrame, rules: CompiledRules) -> DataFrame:
    """Flags of rows ``(patient_id, code, medicine, date)``; one without a medicine is a diagnosis, even if its code is null."""
    rows = _with_lists(visits, F.col("code"), rules, CODE_LISTS, lower=False).drop("term")
    rows = _with_lists(rows, F.col("medicine"), rules, DRUG_LISTS, lower=True)
    return rows.select("patient_id", F.col("medicine").isNull().alias("in_dx"), *_dx_flags(rules), *_med_flags())


def dx_row_flags(dx: DataFrame, rules: Rules) -> DataFrame:
    rules = compiled(rules)
    rows = _with_lists(dx, F.col("code"), rules, CODE_LISTS, lower=False)
    return rows.select("patient_id", F.lit(True).alias("in_dx"), *_dx_flags(rules))


def med_row_flags(med: DataFrame, rules: Rules) -> DataFrame:
    """Flags of the drug orders that a list names; others decide nothing."""
    rules = compiled(rules)
    return _with_lists(_wanted_drugs(med, rules), F.col("medicine"), rules, DRUG_LISTS, lower=True).select(
        "patient_id", *_med_flags())


def event_row_flags(events: DataFrame, rules: CompiledRules, with_stat: bool = False) -> DataFrame:
    """All flags of domain-tagged rows ``(patient_id, domain, name, date, value)``; rows that no rule can use are left out."""
    of = lambda domain: F.when(F.col("domain") == domain, F.col("name"))
    rows = events.select("patient_id", "domain", of("dx").alias("code"), of("med").alias("medicine"),
                         of("lab").alias("test_name"), "date", "value")
    rows = _with_lists(rows, F.col("code"), rules, CODE_LISTS, lower=False).drop("term")
    rows = _with_lists(rows, F.col("medicine"), rules, DRUG_LISTS, lower=True).withColumns(_lab_flags(rules, with_stat))
    used = (F.col("domain") == "dx") | F.col("_in_target_drugs") | F.col("_in_excluding_drugs") | F.col("lab_used")
    return rows.where(used).select("patient_id", (F.col("domain") == "dx").alias("in_dx"), *_dx_flags(rules), *_med_flags(),
                                   *[c for c in _lab_flags(rules, with_stat) if c != "lab_used"])


def _lab_flags(rules: CompiledRules, with_stat: bool) -> dict[str, Column]:
    marker = _marker(F.col("test_name"), rules.inline)
    abnormal = abnormal_lab("test_name", "value", rules.inline.abnormal_labs)
    used, out = marker | abnormal, {"lab_marker": marker, "lab_abnormal": abnormal}
    if with_stat:
        is_stat = F.lower(F.col("test_name")) == F.lit(rules.inline.stat_test.lower())
        used, out = used | is_stat, {**out, "stat_value": F.when(is_stat, F.col("value"))}
    return {**out, "lab_used": F.coalesce(used, F.lit(False))}


def lab_row_flags(lab: DataFrame, rules: Rules, with_stat: bool = False) -> DataFrame:
    """Flags of the lab rows that a rule can use."""
    flags = _lab_flags(compiled(rules), with_stat)
    return lab.where(flags.pop("lab_used")).select("patient_id", *[c.alias(name) for name, c in flags.items()])


def _any(name: str) -> Column:
    return F.coalesce(F.bool_or(name), F.lit(False)).alias(name)


def patient_flags(rules: Rules, dx: DataFrame | None = None,
                  med: DataFrame | None = None, lab: DataFrame | None = None,
                  with_stat: bool = False, visits: DataFrame | None = None,
                  events: DataFrame | None = None) -> DataFrame:
    """One row per patient seen in any given table, with every rule flag.

    Columns: ``patient_id, in_dx, dx_target_row, dx_target_any, dx_excluding,
    dx_related, med_excluding, med_target, first_excluding_date,
    first_target_date, lab_marker, lab_abnormal, dx_target``, where
    ``dx_target`` follows ``rules.exclusion``. Flags of a table that is not
    given are false.
    ``visits`` stands for ``dx`` and ``med`` together, ``events`` for all three (see ``EventTables``).
    ``with_stat`` adds ``stat_sum`` and ``stat_n``: sum and count of the
    values of ``rules.stat_test`` for the patient, from the same pass.
    """
    rules = compiled(rules)
    parts = []
    if events is not None:
        parts.append(event_row_flags(events, rules, with_stat))
    if visits is not None:
        parts.append(visit_row_flags(visits, rules))
    if dx is not None:
        parts.append(dx_row_flags(dx, rules))
    if med is not None:
        parts.append(med_row_flags(med, rules))
    if lab is not None:
        parts.append(lab_row_flags(lab, rules, with_stat))
    if not parts:
        raise ValueError("patient_flags needs at least one event table")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).where(
        F.col("patient_id").isNotNull())
    for name, dtype in (("in_dx", "boolean"), ("dx_target_row", "boolean"), ("dx_target_any", "boolean"),
                        ("dx_excluding", "boolean"), ("dx_related", "boolean"),
                        ("med_excluding", "boolean"), ("med_target", "boolean"),
                        ("excluding_date", "date"), ("target_date", "date"),
                        ("lab_marker", "boolean"), ("lab_abnormal", "boolean")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(dtype))
    aggs = [
        _any("in_dx"), _any("dx_target_row"), _any("dx_target_any"), _any("dx_excluding"),
        _any("dx_related"),
        _any("med_excluding"), _any("med_target"),
        F.min("excluding_date").alias("first_excluding_date"),
        F.min("target_date").alias("first_target_date"),
        _any("lab_marker"), _any("lab_abnormal"),
    ]
    if with_stat:
        if "stat_value" not in rows.columns:
            rows = rows.withColumn("stat_value", F.lit(None).cast("double"))
        aggs += [F.sum("stat_value").alias("stat_sum"), F.count("stat_value").alias("stat_n")]
    flags = rows.groupBy("patient_id").agg(*aggs)
    return flags.withColumn("dx_target", _target_flag(rules.inline.exclusion))


def _target_flag(exclusion: str) -> Column:
    """Target-diagnosis flag of a patient under an exclusion mode."""
    if exclusion == "row":
        return F.col("dx_target_row")
    return F.col("dx_target_any") & ~F.col("dx_excluding")


# --- labels from flags --------------------------------------------------------

def case_branch(target: Column | None = None) -> Column:
    """1, 2 or 3 for the case branch a patient qualifies by, else null."""
    target = F.col("dx_target") if target is None else target
    excl = F.col("med_excluding")
    tgt = F.col("med_target")
    first_before = F.col("first_target_date") < F.col("first_excluding_date")
    return (
        F.when(target & ~excl, F.lit(1))
        .when(target & excl & ~tgt, F.lit(2))
        .when(target & excl & tgt & first_before, F.lit(3))
    )


def is_control() -> Column:
    return F.col("lab_marker") & ~F.col("lab_abnormal") & ~F.col("dx_related")


def label_column(target: Column | None = None) -> Column:
    return (
        F.when(case_branch(target).isNotNull(), F.lit(CASE))
        .when(is_control(), F.lit(CONTROL))
        .when(F.col("in_dx"), F.lit(OTHER))
    )


def table_flags(tables: EventTables, rules: Rules, lab: bool = True, with_stat: bool = False) -> DataFrame:
    """``patient_flags`` of event tables; diagnoses and drug orders of a common source are read in one scan of it."""
    rules = compiled(rules)
    if tables.events is not None:
        events = tables.events if lab else tables.events.where("domain <> 'lab'")
        return patient_flags(rules, events=events, with_stat=with_stat)
    labs = tables.lab if lab else None
    if tables.visits is None:
        return patient_flags(rules, dx=tables.dx, med=tables.med, lab=labs, with_stat=with_stat)

    def mark(rows: DataFrame, name: str) -> DataFrame:
        marked = _with_lists(rows, F.col(name), rules, DRUG_LISTS, lower=True)
        return marked.select(*rows.columns, (F.col("_in_target_drugs") | F.col("_in_excluding_drugs")).alias("wanted"))

    return patient_flags(rules, visits=tables.visits(mark), lab=labs, with_stat=with_stat)


def phenotype(tables: EventTables, rules: Rules) -> DataFrame:
    """``(patient_id string, label int)``: one row per labelled patient."""
    flags = table_flags(tables, rules)
    return (
        flags.select("patient_id", label_column().cast("int").alias("label"))
        .where(F.col("label").isNotNull())
    )


def phenotype_modes(tables: EventTables, rules: Rules) -> DataFrame:
    """``(patient_id, label_row int, label_patient int)``: both exclusion modes, one pass.

    Both labels come from the same flag aggregation (any target row, any
    target-and-not-excluding row, any excluding row), so comparing the modes
    reads and shuffles the events once. The labelled patients are the same in
    both modes (a case needs a diagnosis row, and so does "other").
    """
    flags = table_flags(tables, rules)
    return flags.select(
        "patient_id",
        label_column(_target_flag("row")).cast("int").alias("label_row"),
        label_column(_target_flag("patient")).cast("int").alias("label_patient"),
    ).where(F.col("label_row").isNotNull())


def label_stat(tables: EventTables, rules: Rules) -> DataFrame:
    """Mean of ``rules.stat_test`` per label in one pass over the events.

    ``(label int, mean_value double, n_rows bigint)``; same result as
    :func:`phenolens.operators.stats.lab_mean_by_label` on the labels, but the
    labels and the per-patient sums come out of the same aggregation, so the
    events are read and shuffled once.
    """
    flags = table_flags(tables, rules, with_stat=True)
    return (
        flags.select(label_column().cast("int").alias("label"), "stat_sum", "stat_n")
        .where(F.col("label").isNotNull() & (F.col("stat_n") > 0))
        .groupBy("label")
        .agg((F.sum("stat_sum") / F.sum("stat_n")).alias("mean_value"), F.sum("stat_n").alias("n_rows"))
    )


def label_counts(labels: DataFrame) -> DataFrame:
    """``(label int, n_patients bigint)``."""
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_patients"))


def case_branches(tables: EventTables, rules: Rules) -> DataFrame:
    """``(patient_id, branch int)`` for every case patient."""
    flags = table_flags(tables, rules, lab=False)
    return (
        flags.select("patient_id", case_branch().cast("int").alias("branch"))
        .where(F.col("branch").isNotNull())
    )


def controls(tables: EventTables, rules: Rules) -> DataFrame:
    """``(patient_id)`` meeting the control rules (a diagnosis row is not needed).

    This is the rule set alone; in :func:`phenotype` a patient who is also a
    case keeps the case label.
    """
    flags = patient_flags(rules, dx=tables.dx, lab=tables.lab)
    return flags.where(is_control()).select("patient_id")


# --- single-table patient sets ------------------------------------------------

def dx_target_patients(dx: DataFrame, rules: Rules) -> DataFrame:
    """Patients with a target diagnosis (exclusion applied per ``rules.exclusion``)."""
    rules = compiled(rules)
    if rules.inline.exclusion == "row" and not any(n in rules.long for n in CODE_LISTS):
        target = in_set("code", rules.inline.target_dx) & ~in_set("code", rules.inline.excluding_dx)
        return dx.where(target).select("patient_id").distinct()
    return patient_flags(rules, dx=dx).where(F.col("dx_target")).select("patient_id")


def dx_related_patients(dx: DataFrame, rules: Rules) -> DataFrame:
    """Patients with a related code (in the list, or containing a stem)."""
    rules = compiled(rules)
    if "related_dx" in rules.long:
        return patient_flags(rules, dx=dx).where(F.col("dx_related")).select("patient_id")
    return dx.where(_related_code(F.col("code"), rules.inline)).select("patient_id").distinct()


def lab_marker_patients(lab: DataFrame, rules: Rules) -> DataFrame:
    """Patients with a test whose lower-cased name contains the marker."""
    return lab.where(_marker(F.col("test_name"), compiled(rules).inline)).select("patient_id").distinct()


def lab_abnormal_patients(lab: DataFrame, rules: Rules) -> DataFrame:
    """Marker patients with at least one abnormal lab row."""
    flags = patient_flags(rules, lab=lab)
    return flags.where(F.col("lab_marker") & F.col("lab_abnormal")).select("patient_id")
