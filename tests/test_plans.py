"""What the plans of the registered queries must and must not contain."""

import os
import re

import pytest

from abacist.plans import testdata as data
from abacist.plans.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables are absent")

# The only queries whose result holds text of a document tree.
WITH_PYTHON = {"document_text", "document_text_deep", "flatten_tickets", "ticket_export", "ticket_export_open"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def large(spark):
    """Plan as for tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def nodes(plan: str) -> list[tuple[int, str]]:
    """Depth and text of every operator of a plan tree."""
    found = []
    for line in plan.splitlines():
        body = re.sub(r"^[\s:+|*-]*(\(\d+\)\s*)?", "", line)
        if body:
            found.append((len(line) - len(body), body))
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_stray_python_no_raw_row_window(large, name):
    plan = plan_of(QUERIES[name](large, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert ("EvalPython" in plan) == (name in WITH_PYTHON)
    if name == "team_trend":
        return  # its window runs over the sprint list, which is as long as the calendar
    # whatever goes into one partition has been aggregated (or cut to the top rows) before
    tree = nodes(plan)
    for at, (_, text) in enumerate(tree):
        if text.startswith("Exchange SinglePartition"):
            first = next(t for _, t in tree[at + 1 :] if not t.startswith("Project"))
            assert "Aggregate" in first, (name, first)


def test_period_reaches_the_scan(spark):
    plan = plan_of(QUERIES["invoice_lines"](spark, SF_DIR))
    assert re.search(r"GreaterThanOrEqual\(o_orderdate,1996-03-01", plan)
    assert re.search(r"LessThan\(o_orderdate,1996-04-01", plan)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(set(re.findall(r"(\w+):", s)) == {"l_orderkey", "l_returnflag", "l_linestatus"} for s in scans)


def test_items_are_folded_before_any_join(large):
    """Partial aggregation sits directly on the item scan, below the exchange and the join."""
    plan = plan_of(QUERIES["usage_summary"](large, SF_DIR))
    tree = nodes(plan)
    scan = next(i for i, (_, t) in enumerate(tree) if "l_returnflag" in t and "FileScan" in t)
    above = [t.split("(")[0].split(" ")[0] for _, t in tree[:scan]][::-1]
    operators = [t for t in above if t in ("HashAggregate", "Exchange", "SortMergeJoin")]
    assert operators[:3] == ["HashAggregate", "Exchange", "HashAggregate"]
    assert "Expand" not in plan


def test_a_period_prunes_the_items_at_run_time(large):
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = large.conf.get(key)
    large.conf.set(key, "0")
    try:
        plan = QUERIES["invoice_lines"](large, SF_DIR)._jdf.queryExecution().optimizedPlan()
        lines = plan.toString().splitlines()
    finally:
        large.conf.set(key, before)
    fold = next(i for i, line in enumerate(lines) if "count(item_id" in line)
    assert any("might_contain" in line or "bloom_filter_agg" in line for line in lines[fold:])


def test_a_period_reaches_the_scan_of_items_that_know_it(large, tmp_path):
    from dataclasses import replace

    from abacist.operators import usage as use

    tables = data.usage(large, SF_DIR)
    path = str(tmp_path / "items")
    tables.case_item.join(
        tables.case.selectExpr("case_id", "created_at AS case_created_at"), "case_id"
    ).write.parquet(path)
    timed = replace(tables, case_item=large.read.parquet(path))
    for df in (use.usage_summary(timed, period=data.MONTH), use.status_distribution(timed, data.MONTH)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [s for s in plan.split("FileScan")[1:] if "/items]" in s]
        assert scans and all("GreaterThanOrEqual(case_created_at,1996-03-01" in s for s in scans)


def test_the_session_allows_run_time_pruning_by_large_case_tables(spark):
    limit = spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold")
    assert limit == "100GB"


def test_only_calendar_sized_brackets_are_broadcast_by_hint(large):
    assert "BroadcastHashJoin" in plan_of(QUERIES["stage_latency"](large, SF_DIR))
    for name in ("candidate_depth", "llm_latency_by_client", "usage_summary", "carryover_matrix"):
        assert "BroadcastHashJoin" not in plan_of(QUERIES[name](large, SF_DIR))


def test_matrix_columns_need_no_extra_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("matrix", "matrix")
    data.sprint_issues(spark, SF_DIR)  # schemas are known from here on
    before = len(tracker.getJobIdsForGroup("matrix"))
    QUERIES["carryover_matrix"](spark, SF_DIR)
    assert len(tracker.getJobIdsForGroup("matrix")) == before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
