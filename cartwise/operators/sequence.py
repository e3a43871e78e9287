"""Order-dependent operators: dwell time, visit runs and bursts.

Rows are reduced to distinct (key, second) before any per-key ordering, so one key contributes at most
one row per second of the window however many actions it logged. A suffix window never changes the
successor of a surviving row, hence one ordered pass serves every trailing window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.aggregates import count_where, sum_where
from cartwise.functions.exprs import aggregate, project
from cartwise.functions.ratios import ratio_zero_as_one
from cartwise.windows import Suffixes, WindowSpec

MAX_GAP = 180


def _single(window: WindowSpec) -> Suffixes:
    return Suffixes(window.end, (("w", window.seconds),))


def dwell_multi(
    actions: DataFrame,
    suffixes: Suffixes,
    keys: list[str],
    max_gap: int = MAX_GAP,
    cate: int | None = None,
) -> DataFrame:
    """`dwell_<window>` per key: one plus the gaps to the key's next second that are <= `max_gap`.

    NULL for a window in which the key has no row.
    """
    moments = suffixes.scan(actions, cate).select(*keys, "age").distinct()
    chronological = Window.partitionBy(*keys).orderBy(F.desc("age"))
    gaps = moments.withColumn("gap", F.col("age") - F.lead("age").over(chronological))
    return aggregate(
        gaps,
        keys,
        {f"dwell_{w}": _dwell(suffixes.within(w), "gap", max_gap) for w in suffixes.labels},
    )


def _dwell(seen: str, gap: str, max_gap: int) -> str:
    spent = sum_where(gap, seen, f"{gap} <= {int(max_gap)}")
    return f"if(max({seen}), coalesce({spent}, 0) + 1, NULL)"


def dwell(
    actions: DataFrame,
    window: WindowSpec,
    keys: list[str],
    max_gap: int = MAX_GAP,
    cate: int | None = None,
) -> DataFrame:
    """`dwell` per key over one window."""
    return dwell_multi(actions, _single(window), keys, max_gap, cate).withColumnRenamed("dwell_w", "dwell")


def visit_runs_multi(actions: DataFrame, suffixes: Suffixes, cate: int | None = None) -> DataFrame:
    """`runs_<window>` per (user, item): how often the user left the item for another one.

    Rows are ordered by (user, time, item). Within one second every distinct item ends a run, except
    that the last one continues when the user's next second starts with the same item. So runs are
    distinct (user, second, item) rows minus those continuations, and only one (first item, last item)
    row per user and second has to be ordered.
    """
    touches = suffixes.scan(actions, cate).select("user_id", "sku_id", "age").distinct()
    pair = ["user_id", "sku_id"]
    counts = {w: count_where(suffixes.within(w)) for w in suffixes.labels}
    touched = aggregate(touches, pair, {f"t_{w}": sql for w, sql in counts.items()})
    chronological = Window.partitionBy("user_id").orderBy(F.desc("age"))
    continued = (
        touches.groupBy("user_id", "age")
        .agg(F.min("sku_id").alias("lo"), F.max("sku_id").alias("sku_id"))
        .withColumn("next_lo", F.lead("lo").over(chronological))
        .filter("sku_id = next_lo")
    )
    carried = aggregate(continued, pair, {f"c_{w}": sql for w, sql in counts.items()})
    return project(
        touched.join(carried, pair, "left"),
        pair,
        {f"runs_{w}": f"nullif(t_{w} - coalesce(c_{w}, 0), 0)" for w in suffixes.labels},
    )


def visit_runs(actions: DataFrame, window: WindowSpec, cate: int | None = None) -> DataFrame:
    """`runs` per (user, item) over one window."""
    return visit_runs_multi(actions, _single(window), cate).withColumnRenamed("runs_w", "runs")


def user_moments(actions: DataFrame, suffixes: Suffixes, cate: int) -> DataFrame:
    """One row per user and second: action count, item range and the same for one category.

    `next_age`/`next_lo` describe the user's next second, `next_cate` the next one with `cate`.
    """
    touches = (
        suffixes.scan(actions)
        .groupBy("user_id", "sku_id", "age")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("cate") == cate).alias("hit"))
    )
    in_cate = F.when(F.col("hit"), F.col("sku_id"))
    moments = touches.groupBy("user_id", "age").agg(
        F.sum("n").alias("n"),
        F.min("sku_id").alias("lo"),
        F.max("sku_id").alias("hi"),
        F.count(F.lit(1)).alias("items"),
        F.min(in_cate).alias("cate_lo"),
        F.max(in_cate).alias("cate_hi"),
        F.count(in_cate).alias("cate_items"),
    )
    newest_first = Window.partitionBy("user_id").orderBy("age")
    later = newest_first.rowsBetween(Window.unboundedPreceding, -1)
    marker = F.when(F.col("cate_items") > 0, F.struct("age", F.col("cate_lo").alias("lo")))
    return moments.select(
        "*",
        F.lag("age").over(newest_first).alias("next_age"),
        F.lag("lo").over(newest_first).alias("next_lo"),
        F.last(marker, ignorenulls=True).over(later).alias("next_cate"),
    )


def user_sequence_block(
    actions: DataFrame,
    suffixes: Suffixes,
    cate: int,
    max_gap: int = MAX_GAP,
    burst_label: str | None = None,
) -> DataFrame:
    """Per user and window: dwell and runs over everything and over `cate`, plus bursts of one window.

    Columns: `dwell_<w>`, `cate_dwell_<w>`, `runs_<w>`, `cate_runs_<w>`, `max_burst`, `mean_burst`.
    """
    rows = user_moments(actions, suffixes, cate).selectExpr(
        "*",
        "age - next_age AS gap",
        "age - next_cate.age AS cate_gap",
        "items - if(hi = next_lo, 1, 0) AS ends",
        "cate_items - if(cate_hi = next_cate.lo, 1, 0) AS cate_ends",
    )
    exprs = {}
    for w in suffixes.labels:
        seen = suffixes.within(w)
        cate_seen = f"{seen} AND cate_items > 0"
        exprs[f"dwell_{w}"] = _dwell(seen, "gap", max_gap)
        exprs[f"cate_dwell_{w}"] = _dwell(cate_seen, "cate_gap", max_gap)
        exprs[f"runs_{w}"] = sum_where("ends", seen)
        exprs[f"cate_runs_{w}"] = sum_where("cate_ends", cate_seen)
    if burst_label is not None:
        in_burst = f"if({suffixes.within(burst_label)}, n, NULL)"
        exprs["max_burst"], exprs["mean_burst"] = f"max({in_burst})", f"avg({in_burst})"
    return aggregate(rows, ["user_id"], exprs)


def user_visit_runs(actions: DataFrame, window: WindowSpec, cate: int) -> DataFrame:
    """Runs per user over everything and over the `cate` subsequence, for users seen in `cate`."""
    runs = user_sequence_block(actions, _single(window), cate)
    return project(
        runs.filter("cate_runs_w IS NOT NULL"),
        ["user_id"],
        {
            "cate_runs": "cate_runs_w",
            "total_runs": "runs_w",
            "run_ratio": ratio_zero_as_one("cate_runs_w", "runs_w"),
        },
    )


def bursts(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """`max_burst` and `mean_burst`: most and mean actions per second with any action, per user."""
    per_moment = (
        _single(window).scan(actions).groupBy("user_id", "age").agg(F.count(F.lit(1)).alias("n"))
    )
    return per_moment.groupBy("user_id").agg(
        F.max("n").alias("max_burst"), F.avg("n").alias("mean_burst")
    )
