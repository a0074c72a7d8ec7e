"""DataFrame-in, DataFrame-out operators."""

from .cohort import (
    case_branches,
    controls,
    dx_related_patients,
    dx_target_patients,
    lab_abnormal_patients,
    lab_marker_patients,
    label_counts,
    patient_flags,
    phenotype,
)
from .features import (
    avg_features,
    count_features,
    diagnostic_features,
    feature_index,
    feature_matrix_long,
    feature_tuples,
    indexed_tuples,
    lab_features,
    medication_features,
    patient_vectors,
)
from .metrics import paired_by_patient, paired_purity, pairing, purity
from .moments import feature_covariance, feature_moments, gram_blocks, gram_long, scaled_long
from .rule_table import CompiledRules, as_rule_table, compile_rules
from .stats import lab_mean_by_label

__all__ = [
    "CompiledRules",
    "as_rule_table",
    "avg_features",
    "case_branches",
    "compile_rules",
    "controls",
    "count_features",
    "diagnostic_features",
    "dx_related_patients",
    "dx_target_patients",
    "feature_covariance",
    "feature_index",
    "feature_matrix_long",
    "feature_moments",
    "feature_tuples",
    "gram_blocks",
    "gram_long",
    "indexed_tuples",
    "lab_abnormal_patients",
    "lab_features",
    "lab_marker_patients",
    "lab_mean_by_label",
    "label_counts",
    "medication_features",
    "paired_by_patient",
    "paired_purity",
    "pairing",
    "patient_flags",
    "patient_vectors",
    "phenotype",
    "purity",
    "scaled_long",
]
