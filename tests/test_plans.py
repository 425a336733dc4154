"""The physical plans keep the properties that matter on large data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.conftest import SF_DIR
from tillroll import operators as op

QUERIES = entry_module.queries()


def executed(df):
    """The final plan, after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["purchases_only", "time_range_filter"])
def test_filters_and_columns_reach_the_scan(spark, name):
    scan = next(line for line in planned(QUERIES[name](spark, SF_DIR)).splitlines() if "FileScan" in line)
    assert re.search(r"PushedFilters: \[.*(EqualTo|GreaterThan)", scan)
    assert "props" not in scan.split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["sales_share", "top_products"])
def test_the_total_reuses_the_shuffle_of_the_products(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["sales_share", "top_products", "product_sales"])
def test_no_window_over_all_products(spark, name):
    assert not re.search(r"Window \[sum", planned(QUERIES[name](spark, SF_DIR)))


def test_top_products_keeps_only_the_top(spark):
    assert "TakeOrderedAndProject(limit=10" in planned(QUERIES["top_products"](spark, SF_DIR))


def test_numbering_is_left_out_where_unused(spark):
    assert "row_number" not in planned(QUERIES["daily_sales"](spark, SF_DIR))


def test_copies_are_reduced_before_the_shuffle(spark):
    """A key with very many copies sends one row per map task."""
    copies = spark.range(0, 80_000, 1, 8).select(
        F.lit(1).alias("product_id"), F.lit("s").alias("user_session"), F.col("id").alias("user_id"),
        F.timestamp_seconds(F.lit(0)).alias("event_time"), F.lit("view").alias("event_type"),
    )
    df = op.deduplicate(copies)
    assert [row.user_id for row in df.collect()] == [0]
    node = df._jdf.queryExecution().executedPlan()
    text = node.toString()
    assert text.index("partial_min") > text.index("Exchange hashpartitioning")
    exchange = _first(node.executedPlan() if hasattr(node, "executedPlan") else node, "Exchange")
    assert exchange.metrics().apply("shuffleRecordsWritten").value() <= 8


def _first(node, prefix):
    """Depth-first search for a plan node through adaptive stages."""
    name = node.nodeName()
    if name.endswith("QueryStage"):
        return _first(node.plan(), prefix)
    if name.startswith(prefix):
        return node
    children = node.children()
    for position in range(children.size()):
        found = _first(children.apply(position), prefix)
        if found is not None:
            return found
    return None


def test_profile_reads_each_column_once(spark):
    plan = executed(QUERIES["profile_sample_values"](spark, SF_DIR))
    read = re.findall(r"FileScan parquet \[(\w+)#", plan)
    assert sorted(read) == ["event_id", "event_type", "props", "ts", "user_id", "value"]
    assert "WindowGroupLimit" in plan and plan.count("ReusedExchange") >= len(read)


def test_quality_report_needs_no_sort(spark):
    plan = planned(QUERIES["preprocess_report"](spark, SF_DIR))
    assert "SortAggregate" not in plan and "Sort [" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product_and_no_python(spark, name):
    plan = planned(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapPartitions"):
        assert node not in plan


def test_large_history_is_not_broadcast(spark):
    """Beyond the size Spark checks, the merge is a sort-merge join of distinct rows."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = planned(QUERIES["new_master_rows"](spark, SF_DIR))
    finally:
        spark.conf.set(key, before)
    assert re.search(r"SortMergeJoin.*LeftAnti", plan)
    # The batch is made distinct below the join, so no product is a hot join key.
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")


def test_slices_shuffle_the_events_once(spark):
    """The counts of earlier slices come to the events, not the other way round."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = planned(QUERIES["purchase_movement_sliced"](spark, SF_DIR))
    finally:
        spark.conf.set(key, before)
    join = plan.index("SortMergeJoin [_slice")
    events = plan[join : plan.index("row_number")]
    assert "LeftOuter" in events and "Exchange" not in events and "Sort" not in events.removeprefix("SortMergeJoin")
