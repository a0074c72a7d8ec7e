"""DuckDB SQL for each registered query (the correctness oracle).

The SQL runs against views named after the driver's tables. It is written
step by step, the way the rules read (sets, EXISTS / NOT IN), not in the
one-pass flag form the Spark plans use, so the two are independent.
"""

from __future__ import annotations

import re

from ..rules import (
    SYNTHETIC_ALLOWED_CODES,
    SYNTHETIC_ALLOWED_DRUGS,
    SYNTHETIC_ALLOWED_LABS,
    SYNTHETIC_RULES,
    CohortRules,
)

R = SYNTHETIC_RULES


def _lst(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values)) + ")"


CLINICAL = """
encounter AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderdate AS DATE) AS encounter_date
  FROM orders),
lines AS (
  SELECT e.patient_id, e.encounter_date, l.l_linenumber, l.l_shipdate, p.p_name, p.p_brand, p.p_size
  FROM lineitem l JOIN encounter e ON e.o_orderkey = l.l_orderkey
                  JOIN part p ON p.p_partkey = l.l_partkey),
diagnostic AS (
  SELECT patient_id, concat(p_brand, '.', CAST(p_size % 10 AS VARCHAR)) AS code, encounter_date AS date
  FROM lines WHERE l_linenumber = 1 AND patient_id IS NOT NULL),
medication AS (
  SELECT patient_id, CAST(l_shipdate AS DATE) AS date, p_name AS medicine
  FROM lines WHERE l_linenumber > 1 AND patient_id IS NOT NULL),
lab AS (
  SELECT * FROM (
    SELECT CAST(user_id AS VARCHAR) AS patient_id, CAST(ts AS DATE) AS date,
           event_type AS test_name, CAST(value AS DOUBLE) AS value FROM events)
  WHERE patient_id IS NOT NULL AND date IS NOT NULL AND test_name IS NOT NULL
    AND value IS NOT NULL AND NOT isnan(value))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([CLINICAL.strip()] + [c.strip() for c in ctes if c]) + "\n"


def _abnormal_sql(rules: CohortRules) -> str:
    parts = [f"(lower(test_name) = '{a.test}' AND value {'=' if a.op == '==' else a.op} {a.threshold!r})"
             for a in rules.abnormal_labs]
    return "(" + " OR ".join(parts) + ")"


def _related_sql(rules: CohortRules) -> str:
    parts = [f"code IN {_lst(rules.related_dx)}"] + [
        f"strpos(code, '{s}') > 0" for s in rules.related_contains]
    return "(" + " OR ".join(parts) + ")"


def _dx_case_sql(rules: CohortRules) -> str:
    if rules.exclusion == "row":
        return (f"dx_case AS (SELECT DISTINCT patient_id FROM diagnostic "
                f"WHERE code IN {_lst(rules.target_dx)} AND code NOT IN {_lst(rules.excluding_dx)})")
    return (f"dx_case AS (SELECT DISTINCT patient_id FROM diagnostic d WHERE code IN {_lst(rules.target_dx)} "
            f"AND NOT EXISTS (SELECT 1 FROM diagnostic x WHERE x.patient_id = d.patient_id "
            f"AND x.code IN {_lst(rules.excluding_dx)}))")


def _case_ctes(rules: CohortRules) -> list[str]:
    excl, tgt = _lst(rules.excluding_drugs), _lst(rules.target_drugs)
    return [
        _dx_case_sql(rules),
        f"""med_excl AS (SELECT DISTINCT m.patient_id FROM medication m JOIN dx_case c ON c.patient_id = m.patient_id
                         WHERE lower(m.medicine) IN {excl})""",
        "case1 AS (SELECT patient_id FROM dx_case WHERE patient_id NOT IN (SELECT patient_id FROM med_excl))",
        f"""med_both AS (SELECT DISTINCT patient_id FROM medication
                         WHERE patient_id IN (SELECT patient_id FROM med_excl) AND lower(medicine) IN {tgt})""",
        "case2 AS (SELECT patient_id FROM med_excl WHERE patient_id NOT IN (SELECT patient_id FROM med_both))",
        f"""t1 AS (SELECT patient_id, min(date) AS t1 FROM medication
                   WHERE patient_id IN (SELECT patient_id FROM med_both) AND lower(medicine) IN {excl}
                   GROUP BY patient_id)""",
        f"""t2 AS (SELECT patient_id, min(date) AS t2 FROM medication
                   WHERE patient_id IN (SELECT patient_id FROM med_both) AND lower(medicine) IN {tgt}
                   GROUP BY patient_id)""",
        "case3 AS (SELECT t2.patient_id FROM t2 JOIN t1 ON t1.patient_id = t2.patient_id WHERE t2.t2 < t1.t1)",
        """cases AS (SELECT patient_id, 1 AS branch FROM case1 UNION ALL SELECT patient_id, 2 FROM case2
                     UNION ALL SELECT patient_id, 3 FROM case3)""",
    ]


def _control_ctes(rules: CohortRules) -> list[str]:
    return [
        f"marker AS (SELECT DISTINCT patient_id FROM lab WHERE strpos(lower(test_name), '{rules.lab_marker}') > 0)",
        f"""abnormal AS (SELECT DISTINCT patient_id FROM lab
                         WHERE patient_id IN (SELECT patient_id FROM marker) AND {_abnormal_sql(rules)})""",
        f"related AS (SELECT DISTINCT patient_id FROM diagnostic WHERE {_related_sql(rules)})",
        """controls AS (SELECT patient_id FROM marker
                        WHERE patient_id NOT IN (SELECT patient_id FROM abnormal)
                          AND patient_id NOT IN (SELECT patient_id FROM related))""",
    ]


def _label_ctes(rules: CohortRules) -> list[str]:
    return _case_ctes(rules) + _control_ctes(rules) + [
        """labels AS (
             SELECT patient_id, 1 AS label FROM cases
             UNION ALL SELECT patient_id, 2 FROM controls WHERE patient_id NOT IN (SELECT patient_id FROM cases)
             UNION ALL SELECT DISTINCT patient_id, 3 FROM diagnostic
               WHERE patient_id NOT IN (SELECT patient_id FROM cases)
                 AND patient_id NOT IN (SELECT patient_id FROM controls))""",
    ]


def _tuple_ctes(filtered: bool) -> list[str]:
    if filtered:
        dx_w = f" AND code IN {_lst(SYNTHETIC_ALLOWED_CODES)}"
        med_w = f" AND medicine IN {_lst(SYNTHETIC_ALLOWED_DRUGS)}"
        lab_w = f" AND test_name IN {_lst(SYNTHETIC_ALLOWED_LABS)}"
    else:
        dx_w = med_w = lab_w = ""
    return [
        f"""f_dx AS (SELECT patient_id, code AS feature, CAST(count(*) AS DOUBLE) AS value
                     FROM diagnostic WHERE code IS NOT NULL{dx_w} GROUP BY patient_id, code)""",
        f"""f_lab AS (SELECT patient_id, test_name AS feature, avg(value) AS value
                      FROM lab WHERE test_name IS NOT NULL{lab_w} GROUP BY patient_id, test_name)""",
        f"""f_med AS (SELECT patient_id, medicine AS feature, CAST(count(*) AS DOUBLE) AS value
                      FROM medication WHERE medicine IS NOT NULL{med_w} GROUP BY patient_id, medicine)""",
        """tuples AS (SELECT * FROM f_dx UNION ALL SELECT * FROM f_lab UNION ALL SELECT * FROM f_med)""",
    ]


SPACE = [
    """findex AS (SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS idx
                  FROM (SELECT DISTINCT feature FROM tuples))""",
    """mlong AS (SELECT t.patient_id, f.idx, sum(t.value) AS value
                 FROM tuples t JOIN findex f ON f.feature = t.feature GROUP BY t.patient_id, f.idx)""",
    """npat AS (SELECT CAST(count(DISTINCT patient_id) AS DOUBLE) AS n FROM mlong)""",
    """moments AS (
         SELECT idx, n_present, mean, sd, CASE WHEN sd > 0 THEN -mean / sd ELSE 0.0 END AS zero_value
         FROM (SELECT m.idx, count(*) AS n_present, any_value(a.mean) AS mean,
                      CASE WHEN any_value(n) > 1 THEN
                        sqrt((sum((m.value - a.mean) * (m.value - a.mean))
                              + (any_value(n) - count(*)) * any_value(a.mean) * any_value(a.mean)) / (any_value(n) - 1.0))
                      ELSE 0.0 END AS sd
               FROM mlong m JOIN (SELECT idx, sum(value) / any_value(n) AS mean FROM mlong CROSS JOIN npat GROUP BY idx) a
                 ON a.idx = m.idx CROSS JOIN npat GROUP BY m.idx))""",
]


def oracle_sql() -> dict[str, str]:
    labels_row = _label_ctes(R)
    labels_patient = _label_ctes(R.with_exclusion("patient"))
    q: dict[str, str] = {}
    q["medication_events"] = _with() + "SELECT patient_id, date, medicine FROM medication"
    q["lab_events"] = _with() + "SELECT patient_id, date, test_name, value FROM lab"
    q["diagnostic_events"] = _with() + "SELECT patient_id, code, date FROM diagnostic"
    q["parse_iso_dates"] = "SELECT event_id, CAST(ts AS DATE) AS date FROM events"
    q["lab_events_from_text"] = _with() + (
        "SELECT patient_id, date, test_name, round(round(value * 100.0, 2), 6) AS value FROM lab")
    q["dx_target_patients"] = _with(_dx_case_sql(R)) + "SELECT patient_id FROM dx_case"
    q["dx_related_patients"] = _with() + f"SELECT DISTINCT patient_id FROM diagnostic WHERE {_related_sql(R)}"
    q["lab_marker_patients"] = _with(*_control_ctes(R)) + "SELECT patient_id FROM marker"
    q["lab_abnormal_patients"] = _with(*_control_ctes(R)) + "SELECT patient_id FROM abnormal"
    q["cohort_case_branches"] = _with(*_case_ctes(R)) + "SELECT patient_id, branch FROM cases"
    q["cohort_controls"] = _with(*_control_ctes(R)) + "SELECT patient_id FROM controls"
    q["phenotype_labels"] = _with(*labels_row) + "SELECT patient_id, label FROM labels"
    q["phenotype_labels_from_csv"] = q["phenotype_labels"]
    q["phenotype_label_counts"] = _with(*labels_row) + (
        "SELECT label, count(*) AS n_patients FROM labels GROUP BY label")
    q["phenotype_labels_patient_exclusion"] = _with(*labels_patient) + "SELECT patient_id, label FROM labels"
    q["lab_mean_by_label"] = _with(*labels_row) + (
        f"""SELECT b.label, round(avg(l.value), 6) AS mean_value, count(*) AS n_rows
            FROM lab l JOIN labels b ON b.patient_id = l.patient_id
            WHERE lower(l.test_name) = '{R.stat_test}' GROUP BY b.label""")
    q["lab_mean_by_label_one_pass"] = q["lab_mean_by_label"]
    all_t, filt_t = _tuple_ctes(False), _tuple_ctes(True)
    q["features_diagnostic"] = _with(*all_t) + "SELECT patient_id, feature, value FROM f_dx"
    q["features_medication"] = _with(*all_t) + "SELECT patient_id, feature, value FROM f_med"
    q["features_lab"] = _with(*all_t) + "SELECT patient_id, feature, round(value, 6) AS value FROM f_lab"
    q["features_diagnostic_filtered"] = _with(*filt_t) + "SELECT patient_id, feature, value FROM f_dx"
    q["features_medication_filtered"] = _with(*filt_t) + "SELECT patient_id, feature, value FROM f_med"
    q["features_lab_filtered"] = _with(*filt_t) + (
        "SELECT patient_id, feature, round(value, 6) AS value FROM f_lab")
    q["feature_tuples_all"] = _with(*all_t) + "SELECT patient_id, feature, round(value, 6) AS value FROM tuples"
    q["feature_tuples_filtered"] = _with(*filt_t) + (
        "SELECT patient_id, feature, round(value, 6) AS value FROM tuples")
    space = all_t + SPACE
    q["feature_index"] = _with(*space) + "SELECT feature, idx FROM findex"
    q["feature_matrix_long"] = _with(*space) + "SELECT patient_id, idx, round(value, 6) AS value FROM mlong"
    q["feature_moments"] = _with(*space) + (
        """SELECT idx, n_present, round(mean, 6) AS mean, round(sd, 6) AS sd,
                  round(zero_value, 6) AS zero_value FROM moments""")
    q["scaled_long"] = _with(*space) + (
        """SELECT l.patient_id, l.idx,
                  round(CASE WHEN m.sd > 0 THEN (l.value - m.mean) / m.sd ELSE 0.0 END, 6) AS value
           FROM mlong l JOIN moments m ON m.idx = l.idx""")
    # Centred products over every patient, absent features as zeros: nothing cancels.
    q["feature_covariance"] = _with(*space, """
        centred AS (SELECT p.patient_id, m.idx, coalesce(l.value, 0.0) - m.mean AS z, m.sd
                    FROM (SELECT DISTINCT patient_id FROM mlong) p CROSS JOIN moments m
                    LEFT JOIN mlong l ON l.patient_id = p.patient_id AND l.idx = m.idx),
        products AS (SELECT a.idx AS i, b.idx AS j, sum(a.z * b.z) AS s, any_value(a.sd) * any_value(b.sd) AS d
                     FROM centred a JOIN centred b ON a.patient_id = b.patient_id AND a.idx <= b.idx GROUP BY a.idx, b.idx)""") + (
        """SELECT p.i, p.j, round(CASE WHEN p.d > 0 THEN p.s / (n.n - 1.0) / p.d ELSE 0.0 END, 6) AS covariance
           FROM products p CROSS JOIN npat n""")
    q["patient_vectors"] = _with(*space) + """
        SELECT patient_id, count(*) AS n_entries, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices,
               string_agg(CAST(CAST(round(value, 6) AS DECIMAL(18, 6)) AS VARCHAR), ',' ORDER BY idx) AS values
        FROM mlong GROUP BY patient_id"""
    q["score_saved_model"] = _with(*filt_t, *SPACE, *[_all_arm(c) for c in all_t], """
        seen AS (SELECT t.patient_id, f.idx, sum(t.value) AS value FROM all_tuples t JOIN findex f ON f.feature = t.feature
                 GROUP BY t.patient_id, f.idx),
        scaled AS (SELECT p.patient_id, m.idx,
                          CASE WHEN m.sd > 0 THEN (coalesce(s.value, 0.0) - m.mean) / m.sd ELSE 0.0 END AS z
                   FROM (SELECT DISTINCT patient_id FROM seen) p CROSS JOIN moments m
                   LEFT JOIN seen s ON s.patient_id = p.patient_id AND s.idx = m.idx)""") + (
        "SELECT patient_id, count(*) AS n_components, round(sum(z * z), 6) AS squared_length FROM scaled GROUP BY patient_id")
    q["purity_from_pairs"] = """
        WITH pairs AS (SELECT CAST(vec_id % 3 AS INTEGER) AS cluster, label FROM embeddings),
             counts AS (SELECT cluster, label, count(*) AS n FROM pairs GROUP BY cluster, label),
             per_cluster AS (SELECT cluster, max(n) AS top, sum(n) AS total FROM counts GROUP BY cluster)
        SELECT CAST(coalesce(sum(total), 0) AS BIGINT) AS n_pairs,
               round(CAST(sum(top) AS DOUBLE) / CAST(sum(total) AS DOUBLE), 6) AS purity
        FROM per_cluster"""
    q["purity_cohort_modes"] = _purity_modes_sql()
    q["streaming_kmeans_update"] = _streaming_sql()
    q["streaming_kmeans_stream"] = _streaming_sql()
    for name, same in SAME_RESULT.items():
        q[name] = q[same]
    q["purity_pairing"] = _with(*labels_row, """
        clusters AS (SELECT patient_id, CAST(count(*) % 5 AS INTEGER) AS cluster FROM medication GROUP BY patient_id),
        pairs AS (SELECT c.cluster, l.label FROM clusters c
                  FULL JOIN (SELECT * FROM labels WHERE label < 3) l ON l.patient_id = c.patient_id),
        counts AS (SELECT cluster, label, count(*) AS n FROM pairs
                   WHERE cluster IS NOT NULL AND label IS NOT NULL GROUP BY cluster, label),
        tops AS (SELECT max(n) AS top FROM counts GROUP BY cluster)""") + """
        SELECT (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM counts) AS n_pairs,
               (SELECT count(*) FROM pairs WHERE label IS NULL) AS n_unmatched_clusters,
               (SELECT count(*) FROM pairs WHERE cluster IS NULL) AS n_unmatched_labels,
               round(CAST((SELECT sum(top) FROM tops) AS DOUBLE) / (SELECT sum(n) FROM counts), 6) AS purity"""
    q["kmeans_from_centres"] = _kmeans_sql(3)
    q["mixture_em_step"] = _em_sql()
    return q


#: Queries that give another one's rows by another way.
SAME_RESULT = {
    "medication_events_from_text": "medication_events",
    "diagnostic_events_from_text": "diagnostic_events",
    "phenotype_labels_rule_table": "phenotype_labels",
    "phenotype_labels_long_lists": "phenotype_labels",
    "phenotype_labels_from_store": "phenotype_labels",
    "cohort_case_branches_long_lists": "cohort_case_branches",
    "cohort_controls_rule_table": "cohort_controls",
    "lab_mean_by_label_rule_table": "lab_mean_by_label",
    "feature_tuples_round_trip": "feature_tuples_all",
    "feature_tuples_from_allow_files": "feature_tuples_filtered",
}


def _all_arm(cte: str) -> str:
    """The tuples' CTEs under other names (second copy, for all features beside the filtered ones)."""
    return re.sub(r"\b(f_dx|f_lab|f_med|tuples)\b", r"all_\1", cte)


_POINTS = """
    pts AS (SELECT vec_id, CAST(d - 1 AS INTEGER) AS dim, CAST(embedding[d] AS DOUBLE) AS x
            FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings)),
    seeds AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster
              FROM embeddings ORDER BY vec_id LIMIT 3),
    centres0 AS (SELECT s.cluster, 0.0::DOUBLE AS n, p.dim, p.x AS c FROM seeds s JOIN pts p ON p.vec_id = s.vec_id)"""


def _kmeans_sql(iterations: int) -> str:
    """Lloyd's iterations unrolled: distances, nearest centres and new centres of each."""
    steps = [_POINTS]
    for k in range(iterations):
        steps.append(f"""
    dist{k} AS (SELECT p.vec_id, c.cluster, sum((p.x - c.c) * (p.x - c.c)) AS d2
                FROM pts p JOIN centres{k} c ON c.dim = p.dim GROUP BY p.vec_id, c.cluster),
    near{k} AS (SELECT vec_id, cluster FROM dist{k} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) = 1),
    sums{k} AS (SELECT n.cluster, p.dim, CAST(count(*) AS DOUBLE) AS n, avg(p.x) AS c
                FROM near{k} n JOIN pts p ON p.vec_id = n.vec_id GROUP BY n.cluster, p.dim),
    centres{k + 1} AS (SELECT o.cluster, coalesce(s.n, 0.0) AS n, o.dim, coalesce(s.c, o.c) AS c
                       FROM centres{k} o LEFT JOIN sums{k} s ON s.cluster = o.cluster AND s.dim = o.dim)""")
    return "WITH " + ",".join(steps) + f" SELECT cluster, n, dim, round(c, 6) AS center FROM centres{iterations}"


def _em_sql() -> str:
    """One EM step by its definition: unit covariances, equal weights, log-sum-exp over three components."""
    return "WITH " + _POINTS + """,
    dims AS (SELECT count(DISTINCT dim) AS d, count(DISTINCT vec_id) AS m FROM pts),
    logs AS (SELECT p.vec_id, c.cluster, ln(1.0::DOUBLE / 3) - sum((p.x - c.c) * (p.x - c.c)) / 2
                                         - any_value(d) * ln(2 * pi()) / 2 AS v
             FROM pts p JOIN centres0 c ON c.dim = p.dim CROSS JOIN dims GROUP BY p.vec_id, c.cluster),
    tops AS (SELECT vec_id, max(v) AS top FROM logs GROUP BY vec_id),
    totals AS (SELECT l.vec_id, any_value(top) + ln(sum(exp(v - top))) AS total FROM logs l JOIN tops t ON t.vec_id = l.vec_id GROUP BY l.vec_id),
    resp AS (SELECT l.vec_id, l.cluster, exp(v - total) AS r FROM logs l JOIN totals t ON t.vec_id = l.vec_id),
    held AS (SELECT cluster, sum(r) AS n FROM resp GROUP BY cluster),
    means AS (SELECT r.cluster, p.dim, sum(r.r * p.x) / any_value(h.n) AS mean
              FROM resp r JOIN pts p ON p.vec_id = r.vec_id JOIN held h ON h.cluster = r.cluster GROUP BY r.cluster, p.dim),
    off AS (SELECT r.vec_id, r.cluster, r.r, p.dim, p.x - m.mean AS y
            FROM resp r JOIN pts p ON p.vec_id = r.vec_id JOIN means m ON m.cluster = r.cluster AND m.dim = p.dim),
    cov AS (SELECT a.cluster, a.dim AS i, b.dim AS j, sum(a.r * a.y * b.y) AS s
            FROM off a JOIN off b ON a.vec_id = b.vec_id AND a.cluster = b.cluster AND a.dim <= b.dim GROUP BY a.cluster, a.dim, b.dim)
    SELECT c.cluster AS component, round(h.n / m, 6) AS weight, c.i, c.j, round(e.mean, 6) AS mean,
           round(c.s / h.n, 6) AS covariance, (SELECT round(avg(total), 6) FROM totals) AS likelihood
    FROM cov c JOIN held h ON h.cluster = c.cluster JOIN means e ON e.cluster = c.cluster AND e.dim = c.i CROSS JOIN dims"""


def _purity_modes_sql() -> str:
    row_ctes = _label_ctes(R)
    pat_ctes = [_rename(c) for c in _label_ctes(R.with_exclusion("patient"))]
    return _with(*row_ctes, *pat_ctes, """
        pairs AS (SELECT p.label AS cluster, r.label AS label
                  FROM p_labels p JOIN labels r ON r.patient_id = p.patient_id),
        counts AS (SELECT cluster, label, count(*) AS n FROM pairs GROUP BY cluster, label),
        per_cluster AS (SELECT cluster, max(n) AS top, sum(n) AS total FROM counts GROUP BY cluster)""") + (
        """SELECT CAST(coalesce(sum(total), 0) AS BIGINT) AS n_pairs,
                  round(CAST(sum(top) AS DOUBLE) / CAST(sum(total) AS DOUBLE), 6) AS purity
           FROM per_cluster""")


_CTE_NAMES = ("dx_case", "med_excl", "case1", "med_both", "case2", "t1", "t2", "case3", "cases",
              "marker", "abnormal", "related", "controls", "labels")
_CTE_PATTERN = re.compile(r"\b(" + "|".join(_CTE_NAMES) + r")\b")


def _rename(cte: str) -> str:
    """Prefix every label CTE name with ``p_`` (second copy of the label chain)."""
    return _CTE_PATTERN.sub(lambda m: "p_" + m.group(1), cte)


def _streaming_sql() -> str:
    return """
        WITH pts AS (
               SELECT vec_id, CAST(d - 1 AS INTEGER) AS dim, CAST(embedding[d] AS DOUBLE) AS x
               FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings)),
             seeds AS (
               SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster
               FROM embeddings ORDER BY vec_id LIMIT 3),
             centres AS (SELECT s.cluster, p.dim, p.x AS c FROM seeds s JOIN pts p ON p.vec_id = s.vec_id),
             dist AS (SELECT p.vec_id, c.cluster, sum((p.x - c.c) * (p.x - c.c)) AS d2
                      FROM pts p JOIN centres c ON c.dim = p.dim GROUP BY p.vec_id, c.cluster),
             nearest AS (SELECT vec_id, cluster FROM (
                           SELECT vec_id, cluster,
                                  row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rk
                           FROM dist) WHERE rk = 1),
             counts AS (SELECT cluster, CAST(count(*) AS DOUBLE) AS m FROM nearest GROUP BY cluster),
             sums AS (SELECT n.cluster, p.dim, sum(p.x) AS s
                      FROM nearest n JOIN pts p ON p.vec_id = n.vec_id GROUP BY n.cluster, p.dim),
             upd AS (
               SELECT c.cluster, c.dim, c.c, coalesce(k.m, 0.0) AS m, s.s,
                      0.5 + coalesce(k.m, 0.0) AS w
               FROM centres c LEFT JOIN counts k ON k.cluster = c.cluster
                              LEFT JOIN sums s ON s.cluster = c.cluster AND s.dim = c.dim)
        SELECT cluster, round(w, 6) AS weight, dim,
               round(CASE WHEN m > 0 THEN (1.0 - m / w) * c + (m / w / m) * s ELSE c END, 6) AS center
        FROM upd"""
