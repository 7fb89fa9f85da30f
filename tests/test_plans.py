"""Scale guards on the physical plans of every registered batch query."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

STREAMS = {"realtime_stream", "recent_state_stream", "spool_lines_stream", "spool_provenance_stream", "realtime_two_batches"}
TOP_K = {"genre_top10", "recent_ratings", "recent_items", "similar_unrated_top10",
         "realtime_scores", "realtime_recs_text", "factor_top10", "als_user_top10"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMS))
def test_no_cross_product_and_partial_top_k(spark, name):
    df = entry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name} plans a {bad}"
    if name in TOP_K:
        assert "WindowGroupLimit" in plan and "Partial" in plan, f"{name} lacks a partial top-k limit"
    assert "BatchEvalPython" not in plan, f"{name} runs a row-at-a-time Python UDF"
