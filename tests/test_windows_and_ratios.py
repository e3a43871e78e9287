from __future__ import annotations

from datetime import datetime

from conftest import table

from cartwise.functions.ratios import ratio_or_null, ratio_or_one, ratio_zero_as_one
from cartwise.operators import counts, distinct
from cartwise.windows import DAY, HOUR, Suffixes, WindowSpec, scan_window

W = WindowSpec.of("2024-01-01", "2024-01-11")


def test_window_is_half_open(make_log):
    log = make_log(
        [
            (1, 1, "2024-01-01 00:00:00", 1),
            (2, 1, "2023-12-31 23:59:59", 1),
            (3, 1, "2024-01-10 23:59:59", 1),
            (4, 1, "2024-01-11 00:00:00", 1),
        ]
    )
    assert {r.user_id for r in scan_window(log, W).collect()} == {1, 3}


def test_window_arithmetic():
    assert W.back(days=7).start == datetime(2024, 1, 4)
    assert W.back(hours=4).start == datetime(2024, 1, 10, 20)
    assert W.ahead(days=5) == WindowSpec.of("2024-01-11", "2024-01-16")
    assert W.seconds == 10 * DAY
    assert Suffixes.days(W.end, (1, 7), W).seconds("full") == 10 * DAY


def test_filters_reach_the_scan(spark, make_log, tmp_path):
    path = str(tmp_path / "log")
    make_log([(1, 1, "2024-01-02 00:00:00", 1)]).write.parquet(path)
    plan = scan_window(spark.read.parquet(path), W, 8)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in plan and "LessThan(time" in plan and "EqualTo(cate,8)" in plan


def test_dated_log_prunes_partitions(spark, make_log, tmp_path):
    from cartwise.sources.sinks import write_actions

    path = str(tmp_path / "dated")
    write_actions(
        make_log([(1, 1, "2024-01-02 10:00:00", 1), (2, 1, "2024-01-20 10:00:00", 1)]), path
    )
    scan = scan_window(spark.read.parquet(path), W)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert [r.user_id for r in scan.collect()] == [1]


def test_ratio_rules(spark):
    rows = spark.createDataFrame(
        [(1, 2), (3, 0), (0, 0), (None, 2), (1, None)], "a bigint, b bigint"
    ).selectExpr(
        f"{ratio_zero_as_one('a', 'b')} AS z",
        f"{ratio_or_one('a', 'b')} AS o",
        f"{ratio_or_null('a', 'b')} AS n",
    )
    assert [tuple(r) for r in rows.collect()] == [
        (0.5, 0.5, 0.5),
        (3.0, 1.0, None),
        (0.0, 1.0, None),
        (None, 1.0, None),
        (None, 1.0, None),
    ]


def test_absent_type_is_zero_and_absent_window_is_null(make_log):
    log = make_log([(1, 1, "2024-01-10 23:00:00", 1), (2, 1, "2024-01-05 00:00:00", 2)])
    single = table(counts.action_counts(log, W, ["user_id"]))
    assert single[1]["cnt_1"] == 1 and single[1]["cnt_4"] == 0
    multi = table(counts.action_counts_multi(log, Suffixes.hours(W.end, (4, 240)), ["user_id"]))
    assert multi[2]["cnt_2_4h"] is None and multi[2]["cnt_2_240h"] == 1
    assert multi[1]["cnt_2_4h"] == 0


def test_active_days_over_more_than_one_word(make_log):
    long = WindowSpec.of("2023-01-01", "2024-01-11")
    rows = [(1, 1, datetime(2023, 1, 1 + i % 28, 5), 1) for i in range(56)]
    rows += [(1, 1, f"2024-01-{d:02d} 12:00:00", 1) for d in range(1, 11)]
    assert table(distinct.active_days(make_log(rows), long, ["user_id"]))[1]["day_cnt"] == 38


def test_active_days_with_an_end_inside_a_day(make_log):
    w = WindowSpec.of("2024-01-01 12:00:00", "2024-01-03 12:00:00")
    log = make_log(
        [
            (1, 1, "2024-01-01 11:59:59", 1),
            (1, 1, "2024-01-01 12:00:00", 1),
            (1, 1, "2024-01-03 11:00:00", 1),
            (1, 1, "2024-01-03 11:30:00", 1),
        ]
    )
    assert table(distinct.active_days(log, w, ["user_id"]))[1]["day_cnt"] == 2


def test_multi_window_days_match_single_windows(make_log):
    rows = [(u, u % 3, datetime(2024, 1, 1 + (u * 7 + k * 3) % 10, k), 1) for u in range(6) for k in range(5)]
    log = make_log(rows)
    s = Suffixes.days(W.end, (1, 3, 7), W)
    multi = table(distinct.active_days_multi(log, s, ["user_id"]))
    for label, seconds in s.spans:
        one = table(distinct.active_days(log, W.back(hours=seconds / HOUR), ["user_id"]))
        for user, row in multi.items():
            assert row[f"day_cnt_{label}"] == one.get(user, {"day_cnt": 0})["day_cnt"]


def test_login_matrix_has_a_column_for_every_day(make_log):
    m = table(counts.login_matrix(make_log([(1, 1, "2024-01-02 10:00:00", 1)]), W))[1]
    assert len(m) == 10 and m["login_2024-01-02"] == 1 and m["login_2024-01-03"] == 0


def test_flags_are_per_type(make_log):
    log = make_log([(1, 1, "2024-01-02 10:00:00", 2), (1, 2, "2024-01-02 10:00:00", 4, 7, 1)])
    flags = table(counts.action_flags(log, W, ["user_id", "brand"]), ["user_id", "brand"])
    assert flags[(1, 1)]["has_2"] == 1 and flags[(1, 1)]["has_4"] == 1 and flags[(1, 1)]["has_1"] == 0
