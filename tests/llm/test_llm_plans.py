"""What the pages' and the mixing queries' plans must not hold."""

from __future__ import annotations

import pytest

from layerloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op3_html_text", "op4_pfair_mix", "op8_url_filter", "op10_exact_dedup"])
def test_no_join_of_all_pairs(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert forbidden not in plan


def test_pages_queries_read_their_columns_only(spark, sf_dir):
    plan = QUERIES["op8_url_filter"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan
    assert "Exchange" not in plan
