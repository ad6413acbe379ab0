"""Plan shape of every registered query: no cartesian products and no
nested-loop joins, whatever the data size."""

import pytest

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_pairwise_joins(spark, name):
    df = entry.queries()[name](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in BAD:
        assert op not in plan, f"{name} plans a {op}"


def test_messages_parsed_once(spark):
    for name in ("t03_referenced_fields", "t04_stream_query_projection", "d02_nested_decode", "t07_quarantine", "t07_all_accounted"):
        plan = entry.queries()[name](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, name
