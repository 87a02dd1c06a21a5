"""Plan-shape checks: the scale rules hold in the physical plans."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_bm25_sums_need_no_shuffle(spark):
    df = E.queries()["r5_bm25_search"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the only exchange keyed by query_id is the per-query top-k, not the sums
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id", plan)
    assert "WindowGroupLimit" in plan


def test_search_does_not_shuffle_text(spark):
    df = E.queries()["r5_bm25_search"](spark, SF)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    # text is read in place (round-robin spread only for a single-split input)
    assert not re.search(r"Exchange hashpartitioning\(doc_id#\d+L?, \d+\), REPARTITION_BY_COL.*\n.*text", plan)
