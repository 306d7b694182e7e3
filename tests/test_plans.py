"""What the plans must and must not contain."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidegate.operators.ledger import route_counts
from tidegate.operators.route import OUT_OF_SCOPE, ROUTE, SURVIVOR, routed
from tidegate.registry import QUERIES, on_pages, on_tables

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    name
    for name, query in QUERIES.items()
    if query.__module__ in (on_pages.__name__, on_tables.__name__)
]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def plan_of(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    return frame._jdf.queryExecution().executedPlan().toString()


def formatted(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    return spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("NestedLoop", "Cartesian", "Python", "ArrowEval", "ExistingRDD"):
        assert operator not in plan


# lags over page numbers need every page; parts of a fixed size bound what a task holds
EVERY_ROW = {"page_gaps_by_run"}


@pytest.mark.parametrize("name", sorted({*LAZY} - EVERY_ROW))
def test_windows_are_limited_before_their_exchange(spark, name):
    plan = plan_of(spark, name)
    windows = len(re.findall(r"- Window \[", plan))
    assert len(re.findall(r"WindowGroupLimit .*Partial", plan)) == windows


def test_scope_and_rules_reach_the_scan(spark):
    pushed = re.findall(r"PushedFilters: \[(.*)\]", formatted(spark, "silver_table"))
    assert len(pushed) == 1
    for part in (
        "In(l_returnflag, [A,N])",
        "GreaterThanOrEqual(l_discount,0.0)",
        "LessThanOrEqual(l_discount,0.09)",
        "LessThanOrEqual(l_tax,0.07)",
    ):
        assert part in pushed[0]


def test_scans_read_only_what_is_needed(spark):
    read = re.findall(r"ReadSchema: struct<(.*)>", formatted(spark, "ledger_of_run"))
    assert read[0] == "l_discount:double,l_tax:double,l_returnflag:string"
    assert "l_partkey" not in read[1] and "l_linestatus" not in read[1]


def test_merge_report_reuses_the_partitioning_of_its_inputs(spark):
    plan = plan_of(spark, "merge_change_report")
    join = plan[plan.index("FullOuter") :]
    assert join.index("Window [") < join.index("Exchange")


@pytest.mark.parametrize("query", ["merge_change_report", "merge_upsert_lines"])
def test_merges_evaluate_each_side_once(spark, query):
    plan = plan_of(spark, query)
    assert plan.count("FileScan parquet") == 2
    assert len(re.findall(r"\bWindow \[", plan)) == 2


def test_staged_rows_are_counted_from_footers_and_read_by_route(spark, tmp_path):
    flat = on_tables.flat_lines(spark, SF_DIR)
    rows = routed(flat, on_tables.LINES)
    rows.write.partitionBy(ROUTE).parquet(str(tmp_path / "staged"))
    staged = spark.read.schema(rows.schema).parquet(str(tmp_path / "staged"))
    counts = staged.select(ROUTE).agg(*route_counts())
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()
    surviving = staged.filter(F.col(ROUTE) == SURVIVOR).drop(ROUTE)
    plan = surviving._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan and "PushedFilters: []" in plan
    ignored = staged.filter(F.col(ROUTE) == OUT_OF_SCOPE).drop(ROUTE)
    assert ignored.count() > 0 and ignored.dropna("all").count() == 0
