"""Column helpers for cleaning raw clinical text.

All helpers return JVM-side ``Column`` expressions (no Python UDFs), so they
stay inside whole-stage codegen and compose with Catalyst pushdown.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import AbnormalLab


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column) -> Column:
    """``yyyy-MM-dd`` date from text that may carry a trailing time part.

    ``2010-01-05T00:00:00Z`` and ``2010-01-05`` give 2010-01-05; text that is
    not a date gives null (never an error under ANSI mode).
    """
    return F.try_to_date(F.left(_col(c).cast("string"), F.lit(10)), "yyyy-MM-dd")


def parse_iso_date(c: str | Column) -> Column:
    """UTC calendar date of an ISO-8601 date-time with zone.

    ``2010-01-05T00:00:00Z`` gives 2010-01-05 and ``2010-01-05T00:00:00+02:00``
    gives 2010-01-04 whatever the session time zone; bad text gives null.
    """
    text = _col(c).cast("string")
    instant = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
    )
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / F.lit(86400)).cast("int"))


def parse_number(c: str | Column) -> Column:
    """Double from text with thousands separators: ``1,234.5`` -> 1234.5.

    Empty or non-numeric text gives null; ``NaN`` gives NaN (callers drop it
    with ``na.drop``).
    """
    return F.replace(_col(c).cast("string"), F.lit(","), F.lit("")).try_cast("double")


def in_set(c: str | Column, values: Iterable[str], lower: bool = False) -> Column:
    """Exact membership; ``lower=True`` lower-cases the column first.

    Catalyst turns a list of more than ten literals into an ``InSet`` hash
    lookup and pushes ``In`` into the Parquet scan.
    """
    col = _col(c)
    if lower:
        col = F.lower(col)
    values = list(dict.fromkeys(values))
    if not values:
        return F.lit(False)
    return col.isin(values)


def contains_any(c: str | Column, stems: Iterable[str]) -> Column:
    """True when the column contains any of the literal stems (not regex)."""
    col = _col(c)
    cond = F.lit(False)
    for stem in dict.fromkeys(stems):
        cond = cond | col.contains(stem)
    return cond


def abnormal_lab(test_name: str | Column, value: str | Column,
                 rules: Iterable[AbnormalLab]) -> Column:
    """True when a lab row matches any ``(lower(test) == name) and value <op> threshold``."""
    name = F.lower(_col(test_name))
    val = _col(value)
    cond = F.lit(False)
    for rule in rules:
        threshold = F.lit(float(rule.threshold))
        cmp = {
            ">=": val >= threshold,
            ">": val > threshold,
            "<=": val <= threshold,
            "<": val < threshold,
            "==": val == threshold,
        }[rule.op]
        cond = cond | ((name == F.lit(rule.test)) & cmp)
    return cond
