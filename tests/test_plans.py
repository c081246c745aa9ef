"""The shape of physical plans: what must hold at any scale."""

import re

import pytest

import __spark_entry__ as entry
from fillwatch.operators import tables
from fillwatch.plans.oracles import ORACLES
from fillwatch.sources import adapters as ad

LAZY = sorted(n for n in ORACLES if n != "sensor_alarms_stream" and not n.endswith("_facts"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_row_python(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition"):
        if word == "SinglePartition" and name in SINGLE:
            continue
        assert word not in text, word


# Global figures and the ordered limit end in one row or one bounded result.
SINGLE = {
    "bin_summary",
    "map_center",
    "report_resolution",
    "training_profile",
    "daily_rollup",
    "daily_rollup_kept",
    "performance_parse",
    "performance_recent",
    "sensor_history_sample",
}


def test_time_filters_reach_the_scan(spark, small):
    text = plan(tables.sensor_data(ad.sensor_data(spark, small), ad.AS_OF, 24))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text


def test_only_needed_columns_are_read(spark, small):
    text = plan(entry.queries()["reading_counts"](spark, small))
    assert "ReadSchema: struct<user_id:bigint>" in text


@pytest.mark.parametrize("name", ["latest_by_key", "route_upsert", "temperature_trend", "feature_table"])
def test_ranks_are_limited_before_the_shuffle(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize(
    "name,column",
    [
        ("reports_recent", "o_orderdate"),
        ("reports_resolved", "o_orderdate"),
        ("maintenance_recent", "l_shipdate"),
        ("routes_recent", "l_shipdate"),
    ],
)
def test_time_filters_of_shifted_tables_reach_the_scan(spark, small, name, column):
    text = plan(entry.queries()[name](spark, small))
    assert f"GreaterThanOrEqual({column}," in text
    assert text.count("FileScan parquet") == 1


def joins(node):
    """All joins of an optimised plan."""
    if node.nodeName() == "Join":
        yield node
    children = node.children()
    for i in range(children.size()):
        yield from joins(children.apply(i))


@pytest.mark.parametrize("name", ["training_examples", "training_examples_row_clock", "training_labels_by_hours"])
def test_readings_are_never_joined_by_their_bin_alone(spark, small, name):
    """One bin may hold a third of all readings: what is known of it rides on its hours."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = list(joins(entry.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found
    for join in found:
        on = join.condition().get().toString()
        output = join.left().output()
        sides = {output.apply(i).name() for i in range(output.size())}
        assert "sensor_id" not in sides and "probe" not in sides or " AND " in on, on


@pytest.mark.parametrize("name", ["daily_rollup", "performance_parse"])
def test_stops_are_grouped_once_and_carry_their_own_sums_only(spark, small, name):
    """Nearly every stop is a group of its own: what a task holds is groups times their sums."""
    text = plan(entry.queries()[name](spark, small))
    by_route = [line for line in text.splitlines() if re.search(r"Aggregate\(keys=\[[^\]]*route_id#", line)]
    assert len(by_route) == 2  # before and after the shuffle
    assert all("fill_sum" not in line and "response_sum" not in line for line in by_route)
