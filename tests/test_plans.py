"""Physical-plan properties that matter at scale (checked on sf0.001 plans)."""

import re

from phenolens.plans import queries as Q
from phenolens.operators import cohort, features, rule_table
from phenolens.session import materialize
from phenolens.sources.store import write_event_store

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_labelling_one_patient_exchange(spark):
    p = plan(Q.q_phenotype_labels(spark, SF))
    assert p.count("hashpartitioning(patient_id") == 1
    assert "SinglePartition" not in p


def test_label_stat_is_one_pass_over_events(spark):
    p = plan(Q.q_lab_mean_by_label_one_pass(spark, SF))
    assert p.count("hashpartitioning(patient_id") == 1
    assert p.count("events.parquet") == 1


def test_lab_mean_join_has_preaggregated_sides(spark):
    p = plan(Q.q_lab_mean_by_label(spark, SF))
    # The lab side is folded per patient before the join: two patient_id
    # aggregations (labels, lab sums) and no row-level lab join.
    assert p.count("hashpartitioning(patient_id") == 2


def test_allow_list_pushed_to_scan(spark):
    p = plan(Q.q_features_medication_filtered(spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*In\(p_name", p) or "In(p_name" in p
    p2 = plan(Q.q_features_lab_filtered(spark, SF))
    assert "In(event_type" in p2


def test_column_pruning(spark):
    p = plan(Q.q_phenotype_labels(spark, SF))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        assert "l_quantity" not in schema and "o_totalprice" not in schema and "props" not in schema


def test_feature_index_no_global_window_over_names(spark):
    t = Q._tables(spark, SF)
    index = features.feature_index(features.feature_tuples(t))
    p = plan(index)
    # The range-partitioned ranks are written once and read by both branches.
    files = index.inputFiles()
    assert files and all("phenolens-feature-ranks" in f for f in files)
    # The only single-partition exchange feeds the per-partition counts window.
    assert p.count("SinglePartition") <= 1


def test_mini_batch_assignment_has_no_join(spark):
    from phenolens.streaming import kmeans as skm
    pts = Q._embedding_points(spark, SF)
    centres = skm.centres_frame(spark, [[0.0] * 10, [1.0] * 10, [-1.0] * 10], 0.5)
    p = plan(skm.assign(pts, centres))
    assert "Join" not in p and "Exchange" not in p


def test_phenotype_has_no_python_udf(spark):
    p = plan(cohort.phenotype(Q._tables(spark, SF), Q.RULES))
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_vectors_need_one_shuffle(spark):
    from phenolens.plans import clustering
    sp = clustering.build_feature_space(features.feature_tuples(Q._tables(spark, SF)), materialize=False)
    p = plan(features.patient_vectors(features.indexed_tuples(
        materialize(features.feature_tuples(Q._tables(spark, SF)), "tuples"), sp.index, sp.n_features)))
    # The data moves once, by patient; other exchanges only touch the small
    # per-partition counts of the feature index.
    assert p.count("hashpartitioning(patient_id") == 1


def test_hot_patient_is_combined_before_the_shuffle(spark):
    """A patient owning a third of all rows still sends one row per map task."""
    from helpers import tables
    from phenolens.rules import DIABETES_RULES
    hot = [("hot", "250.02", "2010-01-01")] * 300 + [(f"p{i}", "401.9", "2010-01-01") for i in range(600)]
    t = tables(spark, dx=hot, lab=[("hot", "2010-01-01", "glucose", 90.0)] * 300)
    df = cohort.phenotype(t, DIABETES_RULES)
    p = plan(df)
    head, _, tail = p.partition("Exchange hashpartitioning(patient_id")
    assert "partial_max" in tail and "partial_min" in tail  # combined below the exchange
    assert {r.patient_id: r.label for r in df.collect()}["hot"] == 1


def test_both_exclusion_modes_in_one_pass(spark):
    p = plan(Q.q_purity_cohort_modes(spark, SF))
    assert p.count("hashpartitioning(patient_id") == 1
    assert p.count("events.parquet") == 1


def test_long_form_scoring_stays_in_the_jvm(spark):
    from phenolens.plans import clustering
    sp = clustering.build_feature_space(features.feature_tuples(Q._tables(spark, SF)))
    model, _ = clustering.fit_projection(sp)
    p = plan(clustering.score_long(model, sp.matrix_long))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert p.count("hashpartitioning(patient_id") == 1  # the written vectors are summed already


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_labelling_reads_each_table_once_and_filters_drugs_below_the_encounter_join(spark):
    rules = rule_table.compile_rules(rule_table.as_rule_table(spark, Q.RULES))
    for df in (cohort.phenotype(Q._tables(spark, SF), Q.RULES), cohort.phenotype(Q._tables(spark, SF), rules)):
        p = plan(df)
        assert all(p.count(f"{t}.parquet") == 1 for t in ("lineitem", "orders", "part", "events"))
        o = optimized(df)
        # The join with the parts, which keeps the wanted lines only, lies below the join with the orders.
        tree = o.splitlines()
        parts = next(k for k, line in enumerate(tree) if "Join Inner" in line and "l_partkey" in line)
        orders = next(k for k, line in enumerate(tree) if "Join Inner" in line and "l_orderkey" in line)
        assert orders < parts and indent(tree[orders]) < indent(tree[parts])
        assert "red plate" in tree[parts] or "wanted" in tree[parts]


def indent(line):
    return len(line) - len(line.lstrip(" :+-"))


def test_long_drug_lists_are_joined_with_the_parts_below_the_encounter_join(spark):
    rules = rule_table.compile_rules(rule_table.as_rule_table(spark, Q.RULES), inline_terms=0)
    assert set(rules.long) == {"target_dx", "excluding_dx", "related_dx", "target_drugs", "excluding_drugs"}
    df = cohort.phenotype(Q._tables(spark, SF), rules)
    assert plan(df).count("lineitem.parquet") == 1
    tree = optimized(df).splitlines()
    orders = next(k for k, line in enumerate(tree) if "Join Inner" in line and "l_orderkey" in line)
    below = [line for line in tree[orders + 1:] if indent(line) > indent(tree[orders])]
    assert any("Join LeftOuter, (lower(p_name" in line and "broadcast" in line for line in below)  # size-checked


def test_long_drug_list_on_a_written_table_is_a_semi_join(spark):
    rules = rule_table.compile_rules(rule_table.as_rule_table(spark, Q.RULES), inline_terms=0)
    med = materialize(Q._tables(spark, SF).med, "med")
    assert "LeftSemi" in optimized(cohort.med_row_flags(med, rules))


def test_event_store_needs_no_exchange_on_the_patient(spark):
    t = write_event_store(Q._tables(spark, SF), buckets=4).tables(spark)
    assert "Exchange" not in plan(features.diagnostic_features(t.dx))
    assert "Exchange" not in plan(features.medication_features(t.med))
    vectors = t.dx.selectExpr("patient_id", "cast(length(code) as int) as idx", "1d as value")
    assert "Exchange" not in plan(vectors.groupBy("patient_id", "idx").count())
    labels = cohort.phenotype(t, Q.RULES)
    assert "Exchange" not in plan(labels) and plan(labels).count("FileScan") == 1
    assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, cohort.phenotype(Q._tables(spark, SF), Q.RULES).collect()))
    assert "PushedFilters: [IsNotNull(domain), EqualTo(domain,med)" in plan(t.med)


def test_both_arms_read_one_written_table(spark):
    tagged = materialize(features.tagged_tuples(Q._tables(spark, SF)), "tagged-tuples")
    p = plan(features.allowed_tuples(tagged, allow_drugs=["red plate"], allow_labs=["purchase"]))
    assert "lineitem" not in p and "events.parquet" not in p and "In(" in p or "EqualTo(domain" in p
