"""Print a compact physical-plan summary of registered queries.

Usage: python tools/show_plans.py [sf_dir] [name ...]

For each query: the operator tree of the executed (AQE final) plan with
expression details cut, the exchanges, and the filters pushed into scans.
Queries that fit models are skipped (their plans are Spark ML's).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from phenolens.plans.queries import QUERIES  # noqa: E402
from phenolens.session import local_session  # noqa: E402

DEFAULT = [
    "phenotype_labels", "lab_mean_by_label_one_pass", "purity_cohort_modes", "feature_tuples_filtered",
    "feature_index", "feature_matrix_long", "patient_vectors", "feature_moments", "feature_covariance",
    "streaming_kmeans_update", "pca_projection_long",
]


def tree(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+|-]*)(\*\(\d+\)\s*)?([A-Za-z][A-Za-z]*(?: [A-Z][A-Za-z]*)*)", line)
        if not m:
            continue
        name = m.group(3).strip()
        if name.startswith("HashAggregate") or name.startswith("ObjectHashAggregate"):
            funcs = re.search(r"functions=\[([^\]]*)\]", line)
            partial = funcs and "partial_" in funcs.group(1)
            name += " (partial)" if partial else ""
        prefix = m.group(1)
        extra = ""
        if name.startswith("Exchange"):
            part = re.search(r"(hashpartitioning\([^,]*|rangepartitioning\([^,]*|SinglePartition)", line)
            extra = f" [{part.group(1)})]" if part else ""
        elif name.startswith("Scan") or "FileScan" in name:
            src = re.search(r"([a-z_]+\.parquet|phenolens-[a-z-]+)", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            extra = f" {src.group(1) if src else ''}"
            if pushed and pushed.group(1):
                extra += f" pushed=[{pushed.group(1)[:120]}]"
        out.append(f"{prefix}{name}{extra}")
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = local_session(8)
    for name in names:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final AQE plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        lines = tree(final)
        n_ex = sum("Exchange" in x and "Broadcast" not in x for x in lines)
        n_bc = sum("BroadcastExchange" in x for x in lines)
        print(f"## {name}\n\nshuffle exchanges: {n_ex}, broadcast exchanges: {n_bc}\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
