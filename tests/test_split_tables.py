from __future__ import annotations

import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from test_feature_tables import END, ctx  # noqa: F401

from cartwise.plans import pair_features as pf
from cartwise.plans import partials, split_tables
from cartwise.plans import user_features as uf
from cartwise.plans.splits import rolling_splits
from cartwise.windows import WindowSpec


def rows(df, *drop):
    out = []
    for r in df.drop(*drop).collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=str)


def test_partial_rows_stand_for_the_log(ctx):  # noqa: F811
    window = WindowSpec(END - timedelta(days=65), END)
    made = partials.hourly_partials(ctx.actions, window)
    assert made.agg({"n": "sum"}).first()[0] == ctx.actions.count()
    assert made.filter("time < first OR date <> to_date(first) OR date_trunc('HOUR', time) <> date_trunc('HOUR', first)").count() == 0
    with pytest.raises(ValueError):
        partials.hourly_partials(ctx.actions, WindowSpec(window.start, END + timedelta(minutes=1)))


def test_actions_on_the_hour_keep_their_weight(ctx, make_log):  # noqa: F811
    """On the hour, the hour distance is one more than in the rest of the hour."""
    at = [(1, 1, END - timedelta(hours=h, seconds=s), 1) for h in (1, 2, 30) for s in (0, 1, -1, 1800)]
    log = make_log([*at, (2, 1, END - timedelta(hours=3), 4)])
    plain = replace(ctx, actions=log)
    assert rows(pf.pair_features(partials.with_partials(plain))) == rows(pf.pair_features(plain))


@pytest.mark.parametrize("build", [uf.user_features, pf.training_table])
def test_merged_partials_equal_the_log(ctx, build):  # noqa: F811
    assert rows(build(partials.with_partials(ctx))) == rows(build(ctx))


def test_windows_of_part_hours_read_the_log(ctx):  # noqa: F811
    odd = replace(ctx, window=WindowSpec(ctx.window.start, END - timedelta(minutes=7)))
    assert partials.with_partials(odd).partials is None
    assert pf.pair_features(odd).count() > 0


def test_each_day_is_added_once(ctx, tmp_path):  # noqa: F811
    path = str(tmp_path / "partials")
    first = WindowSpec(END - timedelta(days=20), END - timedelta(days=10))
    partials.update_partials(ctx.actions, first, path)
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith("parquet")}
    # The log has changed since, but days that are there are not scanned again.
    fewer = ctx.actions.filter("user_id > 3")
    table = partials.update_partials(fewer, WindowSpec(END - timedelta(days=20), END), path)
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith("parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    last_old = (END - timedelta(days=10)).date()
    old, new = (table.filter(f"date {op} DATE'{last_old}'") for op in ("<=", ">"))
    start = (END - timedelta(days=20)).replace(hour=0)
    log_old = ctx.actions.filter(f"time >= TIMESTAMP_NTZ'{start}' AND to_date(time) <= DATE'{last_old}'")
    log_new = fewer.filter(f"to_date(time) > DATE'{last_old}'")
    assert old.agg({"n": "sum"}).first()[0] == log_old.count()
    assert new.agg({"n": "sum"}).first()[0] == log_new.count()
    again = partials.update_partials(fewer, WindowSpec(END - timedelta(days=20), END), path, again=True)
    assert again.filter("user_id <= 3").count() == 0


def test_splits_equal_their_direct_tables(ctx, tmp_path):  # noqa: F811
    splits = rolling_splits(END, 30, 5, 5)
    table = split_tables.user_split_table(ctx, splits, str(tmp_path / "t"), str(tmp_path / "p"))
    for split in splits:
        mine = table.filter(f"split = '{split.name}'")
        own = replace(ctx, window=split.features)
        assert rows(mine, "split", "label") == rows(uf.user_features(own))
    assert table.filter("split = 'online' AND label IS NOT NULL").count() == 0
    assert table.filter("split <> 'online' AND label IS NULL").count() == 0
    assert table.filter("label = 1").count() > 0


def test_one_split_is_made_again_alone(ctx, tmp_path):  # noqa: F811
    splits = rolling_splits(END, 20, 5, 5)
    path = str(tmp_path / "t")
    before = split_tables.user_split_table(ctx, splits, path)
    kept = rows(before.filter("split <> 'train'"))
    assert before.filter("split = 'train' AND user_id > 20").count() > 0
    few = replace(ctx, actions=ctx.actions.filter("user_id <= 20"))
    after = split_tables.user_split_table(few, splits[1:2], path)
    assert rows(after.filter("split <> 'train'")) == kept
    assert after.filter("split = 'train' AND user_id > 20").count() == 0 < after.filter("split = 'train'").count()


def test_staging_reads_the_window_alone(spark, tmp_path):
    """The bounds on `ts` reach the scan of the log that is staged."""
    from cartwise.windows import scan_window

    path = str(tmp_path / "log")
    spark.sql("SELECT TIMESTAMP_NTZ'2024-01-10 00:00:00' AS ts, TIMESTAMP_NTZ'2024-01-10 00:00:00' AS time, 1 AS user_id").write.parquet(path)
    rows_ = scan_window(spark.read.parquet(path), WindowSpec(datetime(2024, 1, 1), datetime(2024, 1, 25))).drop("ts")
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
