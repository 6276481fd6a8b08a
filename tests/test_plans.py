"""Shapes of physical plans that would not survive a large cluster."""

import pytest

from wavemeter.plans.fixtures import metric_view, table
from wavemeter.plans import thresholds
from wavemeter.plans.catalog import all_queries
from wavemeter.operators.rollup import rollup_group, rollup_temporal
from wavemeter.operators.threshold import evaluate_spatial
from datetime import datetime

QUERIES = {name: query.run for name, query in all_queries().items()}
BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "sink_", "load_control")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def partition_filters(df):
    """Partition filters of the scans, whole; the text of a plan cuts them off."""
    found, open_nodes = [], [df._jdf.queryExecution().sparkPlan()]
    while open_nodes:
        node = open_nodes.pop()
        if node.nodeName().startswith("Scan"):
            found.append(node.partitionFilters().mkString(" AND "))
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return "\n".join(found)


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_or_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for operator in (
        "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
        "PythonMapInArrow", "FlatMapGroupsInPandas",
    ):
        assert operator not in text, operator


def test_windows_are_partitioned(spark, sf):
    for name in BATCH:
        text = plan(QUERIES[name](spark, sf))
        if "Window [" in text:
            assert "SinglePartition" not in text.split("Window [", 1)[1], name


def test_time_bounds_reach_the_scan(spark, sf):
    cfg = thresholds.config(spark, sf, "NONE", "BY_GROUP", "PT5M")
    facts = metric_view(table(spark, sf, "events"))
    start, end = datetime(2024, 1, 10), datetime(2024, 1, 11)
    text = plan(evaluate_spatial(facts, cfg, 5, start, end))
    assert "GreaterThanOrEqual(ts,2024-01-0" in text
    assert "LessThan(ts,2024-01-11" in text


def test_rollup_reads_partial_aggregates_once(spark, sf):
    facts = metric_view(table(spark, sf, "events"))
    text = plan(rollup_temporal(facts, "15m", sketch=False))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_group_rollup_prunes_columns(spark, sf):
    facts = table(spark, sf, "events")
    from pyspark.sql import functions as F

    view = metric_view(facts).withColumn("ballast", F.col("category"))
    text = plan(rollup_group(view, "15m", sketch=False))
    assert "ballast" not in text


def test_stored_reads_open_only_their_partitions(spark, sf):
    from wavemeter.operators.stored import store_level
    from wavemeter.session import work_folder
    from wavemeter.sources.landed import read_buckets, read_interval

    path = work_folder(spark, "pruned")
    start, end = datetime(2024, 1, 8), datetime(2024, 1, 12)
    store_level(spark, metric_view(table(spark, sf, "events")), path, "15m", start, end, sketch=False)
    part = read_interval(spark, path, datetime(2024, 1, 9), datetime(2024, 1, 10), "hour")
    text = partition_filters(part)
    assert "t2024010900" in text and "t2024010923" in text
    days = [datetime(2024, 1, 8, 5), datetime(2024, 1, 11, 7)]
    text = partition_filters(read_buckets(spark, path, days, "hour"))
    assert "bucket_day#" in text and "t2024010805" in text and "t2024011107" in text
