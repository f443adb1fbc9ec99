"""Every registered query against DuckDB, and what its plan may not hold."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__
import check

SF_DIR = "/root/testdata/sf0.001"
SQL = __spark_entry__.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(__spark_entry__.queries()) - set(__spark_entry__.LLM_QUERIES)))
def test_query(spark, name):
    plans = []

    def run(session, sf_dir):
        frame = __spark_entry__.queries()[name](session, sf_dir)
        plans.append(plan_of(frame))
        return frame

    ok, note = check.compare(spark, SF_DIR, name, run, SQL.get(name))
    assert ok, note
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert forbidden not in plans[0]
    if name not in SQL:
        pytest.skip("it runs, but there is no SQL to compare it with")


def test_entry(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.columns == ["rank", "_id", "distance", "document", "metadata"] and frame.count() == 10


@pytest.mark.parametrize(
    "name, parts",
    [
        ("knn_filtered", ["WindowGroupLimit", "MapInArrow", "BroadcastHashJoin"]),
        ("bm25_any", ["TakeOrderedAndProject"]),
        ("knn_batch", ["WindowGroupLimit", "MapInArrow", "ReadSchema: struct<vec_id:bigint,embedding:array<float>>"]),
        ("bm25_batch", ["WindowGroupLimit", "MapInArrow", "BroadcastHashJoin"]),
        ("get_by_ids", ["LeftSemi"]),
        ("delete_ids", ["LeftAnti"]),
        ("count_rows", ["ReadSchema: struct<doc_id:bigint>"]),
        ("meta_eq", ["ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>"]),
    ],
)
def test_plan(spark, name, parts):
    plan = plan_of(__spark_entry__.queries()[name](spark, SF_DIR))
    for part in parts:
        assert part in plan


def test_a_search_reads_no_texts_it_does_not_need(spark):
    plan = plan_of(__spark_entry__.queries()["knn_batch_filtered"](spark, SF_DIR))
    assert "text" not in plan


def test_one_query_shuffles_no_records(spark):
    """The only exchange moves the few best rows; tables that need no spreading are not moved at all."""
    from hybridframe.operators.nearest import nearest
    from hybridframe.plans.standard import vector_records

    plan = plan_of(nearest(vector_records(spark, SF_DIR), [0.5] * 32, 5, "l2", include=()))
    below = plan.split("TakeOrderedAndProject")[1]
    assert "Exchange" not in below
