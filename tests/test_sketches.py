from __future__ import annotations

import pytest

from cartwise.operators import sketches
from cartwise.windows import WindowSpec

W = WindowSpec.of("2024-01-01", "2024-01-11")


@pytest.fixture
def log(spark):
    """Item i has about 700 * i users, each on several days."""
    return spark.range(60000).selectExpr(
        "id % 10 AS sku_id",
        "pmod(xxhash64(id), 700 * (id % 10) + 5) AS user_id",
        "TIMESTAMP_NTZ'2024-01-01 05:00:00' + make_interval(0, 0, 0, CAST(pmod(xxhash64(id, 1), 10) AS INT)) AS time",
        "CAST(8 AS INT) AS cate",
    )


def exact(log, window):
    rows = log.filter(window.contains()).groupBy("sku_id").agg({"user_id": "count"}).count()
    counted = log.filter(window.contains()).select("sku_id", "user_id").distinct().groupBy("sku_id").count().collect()
    assert rows == len(counted)
    return {r["sku_id"]: r["count"] for r in counted}


def test_estimates_stay_within_the_error_bound(log):
    made = sketches.daily_sketches(log, W, ["sku_id"], "user_id")
    for window in (W, W.back(days=3), WindowSpec.of("2024-01-02", "2024-01-04")):
        want = exact(log, window)
        got = {r["sku_id"]: r["users"] for r in sketches.sketched_distinct(made, window, ["sku_id"], "users").collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - n) <= max(1, 0.07 * n) for k, n in want.items())


def test_days_are_added_and_replaced(spark, log, tmp_path):
    path = str(tmp_path / "sketches")
    for window in (W.back(days=5), WindowSpec.of("2024-01-01", "2024-01-07")):
        sketches.add_daily_sketches(sketches.daily_sketches(log, window, ["sku_id"], "user_id"), path)
    table = spark.read.parquet(path)
    assert table.count() == 10 * 10 and table.select("date").distinct().count() == 10
    got = {r["sku_id"]: r["users"] for r in sketches.sketched_distinct(table, W, ["sku_id"], "users").collect()}
    assert all(abs(got[k] - n) <= max(1, 0.07 * n) for k, n in exact(log, W).items())


def test_part_days_are_refused(log):
    made = sketches.daily_sketches(log, W, ["sku_id"], "user_id")
    with pytest.raises(ValueError):
        sketches.sketched_distinct(made, WindowSpec.of("2024-01-01 06:00:00", "2024-01-03"), ["sku_id"], "n")


def test_null_values_do_not_count(spark, log):
    nulls = log.selectExpr("sku_id", "CAST(NULL AS BIGINT) AS user_id", "time", "cate")
    assert sketches.daily_sketches(nulls, W, ["sku_id"], "user_id").count() == 0
