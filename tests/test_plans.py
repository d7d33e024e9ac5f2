"""Physical-plan checks: the shapes the scale design relies on."""

import pytest

import __spark_entry__ as se
from fairspark.operators import fair, objective, words
from fairspark.plans import tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(se._queries.QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(se.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_word_count_combines_map_side(spark):
    p = plan(words.word_counts(tables.doc_lines(spark, SF, keep_line_no=False)))
    assert "partial_count" in p
    assert p.count("Exchange hashpartitioning(word") == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_fair_stats_scan_pruned_partial_and_jvm_only(spark):
    assigned = objective.assign(tables.p2_points(spark, SF), tables.P2_CENTERS)
    p = plan(fair.cluster_group_stats(assigned, 2))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in p
    assert "partial_var_pop" in p or "partial_sum" in p
    assert "EvalPython" not in p


def test_high_dimension_assignment_uses_arrow_udf(spark):
    cs = tables.p64_centers(spark, SF)
    p = plan(objective.assign(tables.p64_points(spark, SF), cs))
    assert "ArrowEvalPython" in p


def test_center_stats_broadcasts_only_the_counts(spark):
    p = plan(objective.center_stats(tables.p2_points(spark, SF), tables.P2_CENTERS))
    assert "BroadcastHashJoin" in p
