"""Labels, features and purity against plain-Python brute force on random fixtures."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from helpers import tables
from phenolens.operators import cohort, features, metrics
from phenolens.rules import DIABETES_RULES

CODES = ["250.02", "250.4", "250.01", "250.93", "790.21", "V77.1", "401.9", "X250.7", "648"]
DRUGS = ["metformin", "LANTUS", "lantus", "insulin nph", "glucatrol ", "glucatrol", "aspirin", "Actos"]
TESTS = ["glucose", "Glucose", "fasting glucose", "hba1c", "hemoglobin a1c", "glucose, serum",
         "cholesterol", "urine glucose"]


def fixture(seed, n_patients=120):
    rng = random.Random(seed)
    day = lambda: dt.date(2010, 1, 1) + dt.timedelta(days=rng.randrange(6))
    dx, med, lab = [], [], []
    for p in range(n_patients):
        pid = f"p{p}"
        for _ in range(rng.randrange(4)):
            dx.append((pid, rng.choice(CODES), day().isoformat()))
        for _ in range(rng.randrange(4)):
            med.append((pid, None if rng.random() < 0.1 else day().isoformat(), rng.choice(DRUGS)))
        for _ in range(rng.randrange(4)):
            lab.append((pid, day().isoformat(), rng.choice(TESTS), float(rng.choice([5, 6, 90, 110, 111, 200]))))
    return dx, med, lab


def brute_labels(dx, med, lab, rules):
    """The rules applied set by set, as written."""
    excl_dx, tgt_dx = set(rules.excluding_dx), set(rules.target_dx)
    if rules.exclusion == "row":
        dx_case = {p for p, c, _ in dx if c in tgt_dx and c not in excl_dx}
    else:
        has_excl = {p for p, c, _ in dx if c in excl_dx}
        dx_case = {p for p, c, _ in dx if c in tgt_dx} - has_excl
    excl_drugs, tgt_drugs = set(rules.excluding_drugs), set(rules.target_drugs)
    med_excl = {p for p, _, m in med if p in dx_case and m.lower() in excl_drugs}
    case1 = dx_case - med_excl
    med_both = {p for p, _, m in med if p in med_excl and m.lower() in tgt_drugs}
    case2 = med_excl - med_both

    def first(names):
        out = {}
        for p, d, m in med:
            if p in med_both and m.lower() in names and d is not None:
                out[p] = min(out.get(p, d), d)
        return out

    t1, t2 = first(excl_drugs), first(tgt_drugs)
    case3 = {p for p in med_both if p in t1 and p in t2 and t2[p] < t1[p]}
    cases = case1 | case2 | case3
    marker = {p for p, _, n, _ in lab if rules.lab_marker in n.lower()}
    ops = {">=": lambda a, b: a >= b, ">": lambda a, b: a > b}
    abnormal = {p for p, _, n, v in lab if p in marker and any(
        n.lower() == a.test and ops[a.op](v, a.threshold) for a in rules.abnormal_labs)}
    related = {p for p, c, _ in dx if c in set(rules.related_dx) or any(s in c for s in rules.related_contains)}
    controls = marker - abnormal - related
    labels = {p: 1 for p in cases}
    labels.update({p: 2 for p in controls - cases})
    labels.update({p: 3 for p, _, _ in dx if p not in cases and p not in controls})
    return labels


@pytest.mark.parametrize("seed,mode", [(1, "row"), (2, "row"), (3, "patient")])
def test_labels_equal_brute_force(spark, seed, mode):
    dx, med, lab = fixture(seed)
    rules = DIABETES_RULES.with_exclusion(mode)
    got = {r.patient_id: r.label for r in cohort.phenotype(tables(spark, dx, med, lab), rules).collect()}
    expect = brute_labels(dx, med, lab, rules)
    assert got == expect
    assert set(Counter(expect.values())) == {1, 2, 3}  # the fixture reaches every label


def test_tuples_equal_brute_force(spark):
    dx, med, lab = fixture(4)
    got = sorted((r.patient_id, r.feature, round(r.value, 9))
                 for r in features.feature_tuples(tables(spark, dx, med, lab)).collect())
    expect = [(p, n, float(c)) for (p, n), c in Counter((r[0], r[1]) for r in dx).items()]
    expect += [(p, n, float(c)) for (p, n), c in Counter((r[0], r[2]) for r in med).items()]
    sums = defaultdict(list)
    for p, _, n, v in lab:
        sums[(p, n)].append(v)
    expect += [(p, n, round(sum(v) / len(v), 9)) for (p, n), v in sums.items()]
    assert got == sorted(expect)


def test_purity_equal_brute_force(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(4), rng.randrange(3)) for _ in range(500)]
    by_cluster = defaultdict(Counter)
    for c, lab in pairs:
        by_cluster[c][lab] += 1
    expect = sum(max(cnt.values()) for cnt in by_cluster.values()) / len(pairs)
    df = spark.createDataFrame(pairs, "cluster int, label int")
    assert metrics.purity(df).first().purity == pytest.approx(expect)
