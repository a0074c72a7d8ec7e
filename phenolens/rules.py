"""Cohort rules as data.

A :class:`CohortRules` value holds every constant the labelling needs, so the
same operators answer the default type-2-diabetes rule set and the rule set
used against the driver's synthetic tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Comparison operators an abnormal-lab rule may use.
OPERATORS = (">=", ">", "<=", "<", "==")


@dataclass(frozen=True)
class AbnormalLab:
    """A lab row is abnormal when ``lower(test_name) == test`` and ``value <op> threshold``."""

    test: str
    op: str
    threshold: float

    def __post_init__(self) -> None:
        if self.op not in OPERATORS:
            raise ValueError(f"unknown operator {self.op!r}; use one of {OPERATORS}")


@dataclass(frozen=True)
class CohortRules:
    """Case / control / other rules.

    * ``target_dx``, ``excluding_dx``, ``related_dx``: diagnosis codes, matched
      exactly and case-sensitively.
    * ``related_contains``: a code containing any of these stems is related.
    * ``target_drugs``, ``excluding_drugs``: drug names, matched against the
      lower-cased medicine name, whole string, no trimming.
    * ``lab_marker``: a patient has the marker test when the lower-cased test
      name contains it.
    * ``abnormal_labs``: list of :class:`AbnormalLab`.
    * ``stat_test``: the test whose mean by label is reported (exact lower name).
    * ``exclusion``: ``"row"`` tests the excluding codes per diagnosis row,
      ``"patient"`` drops any patient with an excluding code.
    """

    target_dx: tuple[str, ...]
    excluding_dx: tuple[str, ...]
    target_drugs: tuple[str, ...]
    excluding_drugs: tuple[str, ...]
    related_dx: tuple[str, ...]
    related_contains: tuple[str, ...]
    lab_marker: str
    abnormal_labs: tuple[AbnormalLab, ...]
    stat_test: str
    exclusion: str = "row"
    name: str = field(default="custom", compare=False)

    def __post_init__(self) -> None:
        if self.exclusion not in ("row", "patient"):
            raise ValueError("exclusion must be 'row' or 'patient'")

    def with_exclusion(self, exclusion: str) -> "CohortRules":
        from dataclasses import replace

        return replace(self, exclusion=exclusion)


# --- fixed values: default type-2 diabetes rule set --------------------------
# These constants must equal the published phenotype definition for results to
# match; they are listed as given, in their natural order. Duplicates in the
# source lists collapse in a set and are not repeated here.
T1DM_DX = (
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33",
    "250.41", "250.43", "250.51", "250.53", "250.61", "250.63", "250.71", "250.73",
    "250.81", "250.83", "250.91", "250.93",
)
T2DM_DX = (
    "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82",
    "250.7", "250.72", "250.6", "250.62", "250.5", "250.52", "250.4", "250.42",
    "250.00", "250.02",
)
T1DM_MED = (
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente",
    "insulin nph", "insulin reg", "insulin,ultralente",
)
T2DM_MED = (
    "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol",
    "glucotrol xl", "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide",
    "diabeta", "glimepiride", "amaryl", "repaglinide", "prandin", "nateglinide",
    "metformin", "rosiglitazone", "pioglitazone", "acarbose", "miglitol", "sitagliptin",
    "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide", "avandia",
    "actos",
)
DM_RELATED_DX = (
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648",
    "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4", "250.*",
)
DM_RELATED_CONTAINS = ("250.",)
DM_ABNORMAL_LABS = (
    AbnormalLab("hba1c", ">=", 6.0),
    AbnormalLab("hemoglobin a1c", ">=", 6.0),
    AbnormalLab("fasting glucose", ">=", 110.0),
    AbnormalLab("fasting blood glucose", ">=", 110.0),
    AbnormalLab("fasting plasma glucose", ">=", 110.0),
    AbnormalLab("glucose", ">", 110.0),
    AbnormalLab("glucose, serum", ">", 110.0),
)
# -----------------------------------------------------------------------------

DIABETES_RULES = CohortRules(
    target_dx=T2DM_DX,
    excluding_dx=T1DM_DX,
    target_drugs=T2DM_MED,
    excluding_drugs=T1DM_MED,
    related_dx=DM_RELATED_DX,
    related_contains=DM_RELATED_CONTAINS,
    lab_marker="glucose",
    abnormal_labs=DM_ABNORMAL_LABS,
    stat_test="glucose",
    name="type2_diabetes",
)


def _codes(brand: int, digits: str) -> tuple[str, ...]:
    return tuple(f"Brand#{brand}.{d}" for d in digits)


# Rule set for the driver's synthetic tables (codes are "brand.size-digit",
# drugs are part names, lab tests are event types).
SYNTHETIC_RULES = CohortRules(
    target_dx=_codes(1, "02468") + _codes(2, "02468"),
    excluding_dx=_codes(1, "13579") + _codes(2, "13579"),
    target_drugs=("blue bolt", "cold gear", "old ring"),
    excluding_drugs=("red plate", "hot ring"),
    related_dx=("Brand#4.0", "Brand#4.5"),
    related_contains=("Brand#1.", "Brand#2."),
    lab_marker="purchase",
    abnormal_labs=(AbnormalLab("purchase", ">", 190.0), AbnormalLab("error", ">=", 230.0)),
    stat_test="purchase",
    name="synthetic",
)

# Allow-lists for the filtered feature arm on the synthetic tables.
SYNTHETIC_ALLOWED_DRUGS = SYNTHETIC_RULES.target_drugs + SYNTHETIC_RULES.excluding_drugs + (
    "small widget", "hot bolt", "new gear", "red rod")
SYNTHETIC_ALLOWED_LABS = ("purchase", "error", "view")
SYNTHETIC_ALLOWED_CODES = SYNTHETIC_RULES.target_dx + SYNTHETIC_RULES.related_dx
