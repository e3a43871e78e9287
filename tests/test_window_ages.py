"""Rows within half a second of a window's start, and what reaches the file scan."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from cartwise.operators import counts, distinct, sequence
from cartwise.operators.rollup import rollup
from cartwise.windows import HOUR, Suffixes, WindowSpec

END = datetime(2016, 3, 20)
HOURS = (24, 72, 168)


@pytest.fixture
def edges(make_log):
    """For every window: rows half a second, and none, to either side of its start; and one at the end."""
    rows = [(1, 1, END - timedelta(seconds=0.5), 1)]
    for i, h in enumerate(HOURS):
        start = END - timedelta(hours=h)
        rows += [(1 + i % 2, 1 + i, start + timedelta(seconds=s), 1 + i) for s in (-0.5, 0, 0.5)]
    return make_log(rows)


@pytest.mark.parametrize("hours", HOURS)
def test_windows_of_a_family_equal_single_windows(edges, hours):
    window, family = WindowSpec.of(END, END).back(hours=hours), Suffixes.hours(END, HOURS)
    label, pair = f"{hours}h", ["user_id", "sku_id"]

    def single(df, name):
        return {tuple(r[k] for k in df.columns if k != name): r[name] for r in df.collect()}

    def multi(df, keys, name):
        return {tuple(r[k] for k in keys): r[name] for r in df.collect() if r[name]}

    per_key = edges.filter(window.contains()).groupBy(*pair)
    ones = counts.action_counts_multi(edges, family, pair, (1, 2, 3))
    total = ones.select(*pair, sum(F.coalesce(c, F.lit(0)) for c in ones.columns if c.endswith(f"_{label}")).alias("n"))
    assert multi(total, pair, "n") == single(per_key.agg(F.count("*").alias("n")), "n")
    rolled = rollup(family.scan(edges), family, pair, [])
    assert multi(
        rolled.where(f"band <= {hours * HOUR}").groupBy(*pair).agg(F.sum("n").alias("n")), pair, "n"
    ) == single(per_key.agg(F.count("*").alias("n")), "n")

    dwell = sequence.dwell_multi(edges, family, ["user_id"])
    assert multi(dwell, ["user_id"], f"dwell_{label}") == single(sequence.dwell(edges, window, ["user_id"]), "dwell")
    runs = sequence.visit_runs_multi(edges, family)
    assert multi(runs, pair, f"runs_{label}") == single(sequence.visit_runs(edges, window), "runs")
    flow = distinct.people_flow_multi(edges, family, "sku_id")
    people = edges.filter(window.contains()).groupBy("sku_id").agg(F.count_distinct("user_id").alias("n"))
    assert multi(flow, ["sku_id"], f"flow_{label}") == single(people, "n")


@pytest.mark.parametrize("name", ["window_scan", "user_features", "pair_features"])
def test_window_bounds_reach_the_scan_of_the_events(spark, name):
    plan = driver.queries()[name](spark, driver.SMOKE_DIR)._jdf.queryExecution().toString()
    scans = re.findall(r"PushedFilters: \[([^\]]*\bts\b[^\]]*)", plan)
    assert scans and all("GreaterThanOrEqual(ts" in s and "LessThan(ts" in s for s in scans)


@pytest.mark.parametrize("name", ["user_action_cnt", "item_features", "ub_share"])
def test_queries_run_without_a_broadcast_threshold(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert driver.queries()[name](spark, driver.SMOKE_DIR).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ingest_keeps_rows_of_any_month(spark, tmp_path):
    events = spark.createDataFrame(
        [(datetime(2023, 5, 1), 1, "view", 1.0, '{"k": 1}'), (datetime(2025, 5, 1), 1, "view", 1.0, '{"k": 1}'),
         (datetime(2024, 1, 15), 2, "click", 1.0, '{"k": 1}'), (datetime(2024, 1, 15), 2, "click", 1.0, "{}")],
        "ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    part = spark.createDataFrame([(1, "Brand#1", "ECONOMY", 1)], "p_partkey long, p_brand string, p_type string, p_size int")
    events.write.parquet(f"{tmp_path}/events.parquet")
    part.write.parquet(f"{tmp_path}/part.parquet")
    assert driver.queries()["ingest_actions"](spark, str(tmp_path)).count() == 3
