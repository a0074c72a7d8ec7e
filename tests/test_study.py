"""The whole study from raw CSV files and allow-list files."""

import os

from phenolens.plans import study
from phenolens.rules import (
    SYNTHETIC_ALLOWED_CODES,
    SYNTHETIC_ALLOWED_DRUGS,
    SYNTHETIC_ALLOWED_LABS,
    SYNTHETIC_RULES,
)
from phenolens.sources import synthetic


def test_study_from_raw_files(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    synthetic.write_raw_csvs(spark, "/root/testdata/sf0.001", raw)
    allow = os.path.join(tmpdir_fresh, "allow")
    os.makedirs(allow)
    for name, terms in (("med_filter.txt", SYNTHETIC_ALLOWED_DRUGS), ("lab_filter.txt", SYNTHETIC_ALLOWED_LABS),
                        ("icd9_filter.txt", SYNTHETIC_ALLOWED_CODES)):
        with open(os.path.join(allow, name), "w") as fh:
            fh.write("\n".join(terms) + "\n")
    s = study.run_study(spark, raw, allow, rules=SYNTHETIC_RULES)
    assert s.labels.count() == 148
    # Code terms are lower-cased on load and the codes are mixed case: no dx tuples survive.
    filtered_names = {r.feature for r in s.tuples_filtered.select("feature").distinct().collect()}
    assert not any(n.startswith("Brand#") for n in filtered_names)
    assert len(filtered_names) == len(SYNTHETIC_ALLOWED_DRUGS) + len(SYNTHETIC_ALLOWED_LABS)
    rows = study.format_report(s.report).collect()
    assert [(r.feature_set, r.algorithm) for r in rows] == [
        (fs, alg) for fs in ("all", "filtered") for alg in ("kmeans", "gmm", "streaming_kmeans")]
    assert all(len(r.purity.split(".")[1]) == 5 for r in rows)
    # Every labelled patient has some feature; fewer have an allow-listed one.
    assert [r.n_pairs for r in rows[:3]] == [148] * 3
    assert all(0 < r.n_pairs <= 148 for r in rows[3:])
