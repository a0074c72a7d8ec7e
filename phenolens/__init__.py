"""phenolens: cohort phenotyping and patient clustering on Spark DataFrames."""

from .rules import DIABETES_RULES, SYNTHETIC_RULES, AbnormalLab, CohortRules
from .sources.clinical import EventTables

__all__ = ["DIABETES_RULES", "SYNTHETIC_RULES", "AbnormalLab", "CohortRules", "EventTables"]
