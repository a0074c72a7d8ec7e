"""JVM-side column helpers (no Python UDFs)."""

from .columns import (
    abnormal_lab,
    contains_any,
    in_set,
    parse_date,
    parse_iso_date,
    parse_number,
)

__all__ = [
    "abnormal_lab",
    "contains_any",
    "in_set",
    "parse_date",
    "parse_iso_date",
    "parse_number",
]
