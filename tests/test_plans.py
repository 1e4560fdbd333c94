import re

"""Plan guards: shapes that would not survive 1000x more data must not appear."""

import pytest

import __spark_entry__ as entry
from ledgerlift.session import recorded_plans
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(spark, name) -> str:
    """The plans of a registered query: what its materializations ran, and the final one."""
    with recorded_plans() as plans:
        df = entry.queries()[name](spark, SF_SMALL)
        return "\n".join([*plans, df._jdf.queryExecution().executedPlan().toString()])


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_no_cartesian_nested_loop_or_python(spark, name):
    text = plan_text(spark, name)
    bad = [op for op in FORBIDDEN if op in text]
    assert not bad, f"{name}: {bad}"


def test_scans_are_pruned(spark):
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan_text(spark, "customer_stats")
    text = plan_text(spark, "scan_importance")
    assert "o_totalprice" in text and "o_orderdate" not in text.split("ReadSchema")[1]


def _single_partition_exchanges(text: str) -> int:
    # a window without partition keys (or a global sort) needs all rows in one task
    return text.count("Exchange SinglePartition")


def test_rank_plans_never_gather_rows_into_one_task(spark):
    # positive control: chunk numbering has exactly one, over per-partition counts
    chunk = plan_text(spark, "chunk_assignment")
    assert _single_partition_exchanges(chunk) == 1
    for name in ("customer_stats", "importance_scores", "detections",
                 "detect_upgrades_hot_merchant", "importance_scores_hot_merchant",
                 "monthly_detection_stats", "eligible_stats"):
        text = plan_text(spark, name)
        assert "Window [" in text, name
        assert _single_partition_exchanges(text) == 0, name
    # per chunk, only the chunk numbering's own offsets (one row per partition) meet in one task
    text = plan_text(spark, "detect_upgrades_per_chunk")
    assert _single_partition_exchanges(text) <= 2 and "__ll_cnt" in text


def test_chunk_progress_sums_chunks_without_gathering_them(spark):
    text = plan_text(spark, "chunk_progress")
    # SinglePartition only for the offsets and for partial sums of the total; no window over all chunks
    assert _single_partition_exchanges(text) == 1 + text.count("partial_sum(size")
    assert not re.search(r"Window \[sum\(size", text) and "ubquery" in text
