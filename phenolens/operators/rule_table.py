"""Cohort rules as a table, compiled to predicates and term joins.

A rule table has one row a term: ``(rule string, term string, op string,
threshold double)``, with ``rule`` one of the names below; ``op`` and
``threshold`` belong to ``abnormal_labs``. It may come from a file, a catalog
or another query, and its lists may be long.

:func:`compile_rules` splits it by measured size. Lists of at most
``INLINE_TERMS`` terms become literals (Catalyst turns them into ``In`` /
``InSet`` and moves them down to the scans). Longer lists stay DataFrames and
are joined: drug orders pass a left semi join, which Catalyst moves below the
encounter join, before they meet their flags. The term side is broadcast only
if its measured bytes are at most ``BROADCAST_TERM_BYTES``; above that the join
is left to a shuffle with AQE's skew handling.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import AbnormalLab, CohortRules

RULE_SCHEMA = "rule string, term string, op string, threshold double"
CODE_LISTS = ("target_dx", "excluding_dx", "related_dx")
DRUG_LISTS = ("target_drugs", "excluding_drugs")
#: Always inline: each entry is a predicate of its own, not a set member.
PREDICATES = ("related_contains", "abnormal_labs")
SCALARS = ("lab_marker", "stat_test", "exclusion")
INLINE_TERMS = 1000
BROADCAST_TERM_BYTES = 64 << 20


@dataclass(frozen=True)
class CompiledRules:
    """Inline rules, and per long list a one-column DataFrame ``term`` with its measured bytes."""

    inline: CohortRules
    long: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)

    def flags_of_terms(self, names: tuple[str, ...]) -> DataFrame | None:
        """``(term, one boolean for each name)`` of the long lists among ``names``; None if all are inline."""
        frames = [self.long[n][0].select("term", *[F.lit(n == other).alias(other) for other in names])
                  for n in names if n in self.long]
        if not frames:
            return None
        rows = frames[0]
        for more in frames[1:]:
            rows = rows.unionByName(more)
        return rows.groupBy("term").agg(*[F.bool_or(n).alias(n) for n in names])

    def bounded(self, terms: DataFrame, names: tuple[str, ...]) -> DataFrame:
        """``terms`` marked for broadcast if the long lists among ``names`` are small enough."""
        size = sum(self.long[n][1] for n in names if n in self.long)
        return F.broadcast(terms) if size <= BROADCAST_TERM_BYTES else terms


def as_rule_table(spark: SparkSession, rules: CohortRules) -> DataFrame:
    """The rules as a rule table."""
    rows = [(name, term, None, None) for name in (*CODE_LISTS, *DRUG_LISTS, "related_contains") for term in getattr(rules, name)]
    rows += [("abnormal_labs", a.test, a.op, float(a.threshold)) for a in rules.abnormal_labs]
    rows += [(name, getattr(rules, name), None, None) for name in SCALARS]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def compile_rules(table: DataFrame, inline_terms: int = INLINE_TERMS) -> CompiledRules:
    """Rules from a rule table. Null terms are skipped, repeated ones count once, a missing list is empty.

    Only the sizes and the lists of at most ``inline_terms`` terms reach the driver.
    """
    known = {*CODE_LISTS, *DRUG_LISTS, *PREDICATES, *SCALARS}
    terms = table.where(F.col("term").isNotNull()).select("rule", "term", "op", "threshold").distinct()
    sizes = {r["rule"]: (r["n"], r["bytes"]) for r in terms.groupBy("rule").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term") + F.lit(16)).alias("bytes")).limit(len(known) + 1).collect()}
    if unknown := sorted(set(sizes) - known):
        raise ValueError(f"unknown rules {unknown}; use {sorted(known)}")
    if too_many := [n for n in (*PREDICATES, *SCALARS) if sizes.get(n, (0, 0))[0] > (INLINE_TERMS if n in PREDICATES else 1)]:
        raise ValueError(f"too many rows for {too_many}")
    if "lab_marker" not in sizes:
        raise ValueError("the rules name no lab_marker")
    long_lists = [n for n in (*CODE_LISTS, *DRUG_LISTS) if sizes.get(n, (0, 0))[0] > inline_terms]
    short = [n for n in sizes if n not in long_lists]
    rows = terms.where(F.col("rule").isin(short)).orderBy("rule", "term", "op", "threshold").collect() if short else []
    of = lambda name: [r for r in rows if r["rule"] == name]
    one = lambda name, default: next((r["term"] for r in of(name)), default)
    inline = CohortRules(
        **{n: tuple(r["term"] for r in of(n)) for n in (*CODE_LISTS, *DRUG_LISTS, "related_contains")},
        lab_marker=one("lab_marker", ""), stat_test=one("stat_test", ""), exclusion=one("exclusion", "row"),
        abnormal_labs=tuple(AbnormalLab(r["term"], r["op"], r["threshold"]) for r in of("abnormal_labs")), name="table")
    return CompiledRules(inline, {n: (terms.where(F.col("rule") == n).select("term"), sizes[n][1]) for n in long_lists})


def compiled(rules: CohortRules | CompiledRules) -> CompiledRules:
    return rules if isinstance(rules, CompiledRules) else CompiledRules(rules)


def drug_terms(rules: CompiledRules) -> tuple[str, ...]:
    """The inline drug names of both lists."""
    return tuple(dict.fromkeys(rules.inline.target_drugs + rules.inline.excluding_drugs))
