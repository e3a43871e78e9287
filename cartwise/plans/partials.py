"""Hourly partial counts of the log, from which every trailing window of whole hours is merged.

A row holds how often a user did one type of action on an item within an hour, with the first and the last
time. Its `time` is the last one, so window scans, ages and day bitmaps work on partial rows as they do on log
rows; `rollup` adds `n` up instead of counting. Actions right on the hour are rows of their own, because their
hour distance, and so their recency weight, is one more than that of the rest of the hour.

The table is partitioned by date and written day by day: days that it has are not scanned again, so windows
that overlap, like those of rolling splits, share them.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.exprs import aggregate
from cartwise.plans.context import FeatureContext
from cartwise.plans.user_features import candidates, reach
from cartwise.sources.sinks import replace_partitions, scratch_folder, stage_actions
from cartwise.windows import WindowSpec, scan_window

KEYS = ["user_id", "sku_id", "cate", "brand", "type", "time_zone"]
SCHEMA = (
    "user_id long, sku_id long, cate int, brand int, type int, time_zone int, "
    "time timestamp_ntz, first timestamp_ntz, n long, date date"
)

_COLUMNS = [column.split() for column in SCHEMA.split(", ")]


def on_whole_hours(window: WindowSpec) -> bool:
    """Whether the window's ends are whole hours, which merging hours into it needs."""
    return all(t.minute == t.second == t.microsecond == 0 for t in (window.start, window.end))


def hourly_partials(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """The partial rows of a window."""
    if not on_whole_hours(window):
        raise ValueError("partial rows need a window of whole hours")
    hour = "date_trunc('HOUR', time)"
    rows = scan_window(actions, window).selectExpr(*KEYS, "time", f"{hour} AS hour", f"time = {hour} AS on_hour")
    counted = aggregate(rows, [*KEYS, "hour", "on_hour"], {"last": "max(time)", "first": "min(time)", "n": "count(1)"})
    named = counted.selectExpr(*KEYS, "last AS time", "first", "n", "to_date(hour) AS date")
    return named.selectExpr(*[f"cast({name} AS {kind}) AS {name}" for name, kind in _COLUMNS])


def update_partials(actions: DataFrame, window: WindowSpec, path: str, again: bool = False) -> DataFrame:
    """The partial table at `path` with all days of the window; days that it has are left as they are, unless
    `again` replaces them. A window that starts or ends inside a day is taken to whole days."""
    spark = actions.sparkSession
    start = window.start.replace(hour=0, minute=0, second=0, microsecond=0)
    end = window.end - timedelta(microseconds=1)
    days = [start.date() + timedelta(days=i) for i in range((end.date() - start.date()).days + 1)]
    if not again:
        known = spark.read.schema(SCHEMA).option("basePath", path)
        have = {r["date"] for r in known.parquet(path).select("date").distinct().collect()} if _exists(spark, path) else set()
        days = [d for d in days if d not in have]
    for first, last in _runs(days):
        begin = start + timedelta(days=(first - start.date()).days)
        run = WindowSpec(begin, begin + timedelta(days=(last - first).days + 1))
        replace_partitions(hourly_partials(actions, run), path, ["date"])
    return spark.read.schema(SCHEMA).parquet(path)


def _runs(days: list) -> list[tuple]:
    """First and last days of the runs of consecutive days."""
    out: list[list] = []
    for day in days:
        if out and day - out[-1][1] == timedelta(days=1):
            out[-1][1] = day
        else:
            out.append([day, day])
    return [tuple(run) for run in out]


def _exists(spark, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def log_reach(ctx: FeatureContext) -> WindowSpec:
    """What all blocks of a context read of the log: brand membership may go back further than the others."""
    blocks = reach(ctx)
    return WindowSpec(min(blocks.start, ctx.log_start or blocks.start), blocks.end)


def with_partials(ctx: FeatureContext, path: str | None = None) -> FeatureContext:
    """The context with partial rows for everything that counts, and the candidates' recent log rows, written
    too, for what needs every second. The log is scanned once for each. Windows that are no whole hours keep
    the log itself.

    `path` is a partial table to share and add to; without one a table of this context's own is written.
    """
    if ctx.partials is not None or not on_whole_hours(log_reach(ctx)):
        return ctx
    if path is None:
        path = scratch_folder(ctx.actions.sparkSession)
        rows = hourly_partials(ctx.actions, log_reach(ctx)).drop("date")
        rows.write.parquet(path)
        partials = rows.sparkSession.read.schema(rows.schema).parquet(path)
    else:
        partials = update_partials(ctx.actions, log_reach(ctx), path)
    ctx = replace(ctx, partials=partials)
    recent = ctx.window.back(days=SEQUENCE_REACH)
    rows = ctx.actions.select("user_id", "sku_id", "time", "type", "cate", "brand", *_ts(ctx.actions))
    kept = rows.join(candidates(ctx), "user_id", "left_semi")
    return replace(ctx, candidate_actions=stage_actions(kept, recent, ("ts",)))


SEQUENCE_REACH = 7  # days that dwell, runs and bursts look back


def _ts(actions: DataFrame) -> list[str]:
    return [c for c in ("ts", "date") if c in actions.columns]
