"""User features of the candidate users.

One wide aggregate per user over the log and one ordered pass over the last week provide nearly every
column. Candidates, buyers and rule users are conditions on those aggregates rather than further scans.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.aggregates import is_type
from cartwise.functions.exprs import Exprs, aggregate, project
from cartwise.functions.ratios import ratio_or_one, ratio_zero_as_one
from cartwise.operators.labels import with_label
from cartwise.operators.recency import user_base
from cartwise.operators.rollup import (
    days_where,
    oldest_where,
    rollup,
    rows_where,
    weights_where,
    within,
    youngest_where,
)
from cartwise.operators.sequence import user_sequence_block
from cartwise.plans.context import FeatureContext
from cartwise.schema import NON_BUY_TYPES, TIME_ZONES, USER_TOTAL_TYPES, ActionType
from cartwise.sources.sinks import stage_actions
from cartwise.windows import DAY, Suffixes, WindowSpec, scan_window

BUY, CART, BROWSE, CLICK = (
    int(ActionType.BUY),
    int(ActionType.CART),
    int(ActionType.BROWSE),
    int(ActionType.CLICK),
)
USER = ["user_id"]

# Window lengths in days, counted types, rule thresholds.
USER_SPANS = (1, 2, 3, 5, 7, 10, 14, 15, 28)
USER_DAY_SPANS = ("7d", "15d", "28d", "full")
USER_TOTAL_SPANS = ("1d", "3d", "5d", "7d", "10d", "14d", "15d", "28d", "full")
CATE_TOTAL_SPANS = ("1d", "2d", "3d", "5d", "7d", "15d", "28d", "full")
CATE_DAY_SPANS = ("7d", "15d")
SEQUENCE_DAYS = (1, 2, 3, 5, 7)
CATE_COUNT_TYPES = (2, 4, 5)
RULE_LEVEL, RULE_DAYS = 2, 2
# The longest window of any user, pair or brand block but `full`.
MOST_DAYS = 28


def user_block(ctx: FeatureContext) -> DataFrame:
    """One row per user with every additive measure the feature tables use.

    `u_*` columns cover all categories, `c_*` the target category, `o_*` the others. Unused columns are
    pruned from the aggregate by the optimizer.
    """
    s = Suffixes.days(ctx.end, (*USER_SPANS, ctx.candidate_days), ctx.window)
    full, week, fortnight = within(s, "full"), within(s, "7d"), within(s, "15d")
    lately = f"band <= {int(ctx.candidate_days * DAY)}"
    exprs: Exprs = {
        "c_rows_lately": rows_where("here", lately),
        "c_buys_lately": rows_where(is_type(BUY), "here", lately),
        "u_rows_full": rows_where(full),
        "u_last_dist": youngest_where(full),
        "u_first_dist": oldest_where(full),
        "c_last_dist": youngest_where("here", full),
        "o_rows_7d": rows_where("NOT here", week),
        "u_carts_full": rows_where(is_type(CART), full),
        "c_browse_full": rows_where(is_type(BROWSE), "here", full),
        "c_browse_7d": rows_where(is_type(BROWSE), "here", week),
        "c_buys_full": rows_where(is_type(BUY), "here", full),
        "c_browse_15d": rows_where(is_type(BROWSE), "here", fortnight),
        "c_click_15d": rows_where(is_type(CLICK), "here", fortnight),
    }
    longest = max(seconds for _, seconds in s.spans)
    for w in USER_DAY_SPANS:
        exprs[f"u_days_{w}"] = days_where(ctx.end, longest, within(s, w))
    for w in CATE_DAY_SPANS:
        exprs[f"c_days_{w}"] = days_where(ctx.end, longest, "here", within(s, w))
    for w in USER_TOTAL_SPANS:
        exprs[f"u_total_{w}"] = rows_where(is_type(*USER_TOTAL_TYPES), within(s, w))
    for w in CATE_TOTAL_SPANS:
        exprs[f"c_total_{w}"] = rows_where("here", within(s, w))
    for t in CATE_COUNT_TYPES:
        exprs[f"c_cnt_{t}_7d"] = rows_where(is_type(t), "here", week)
    for t in NON_BUY_TYPES if ctx.curve is not None else ():
        exprs[f"c_decay_{t}_15d"] = weights_where(is_type(t), "here", fortnight)
    for z in TIME_ZONES:
        exprs[f"c_tz_{z}_7d"] = rows_where(f"zone = {z}", "here", week)
    rows = ctx.weighted(s.scan(ctx.counted)).selectExpr("*", f"cate = {int(ctx.cate)} AS here")
    zoned = rows.selectExpr("*", f"if(here AND age <= {7 * DAY}, time_zone, NULL) AS zone")
    return aggregate(rollup(zoned, s, USER, ["here", "zone"], ctx.placed), USER, exprs)


def candidates(ctx: FeatureContext) -> DataFrame:
    """Users active in the target category in the last `candidate_days` who did not buy there."""
    recent = scan_window(ctx.counted, ctx.window.back(days=ctx.candidate_days), ctx.cate)
    return aggregate(recent, USER, {"buys": f"count_if({is_type(BUY)})"}).filter("buys = 0").select("user_id")


def of_candidates(ctx: FeatureContext) -> FeatureContext:
    """The context with the candidates' part of the log: their rows are chosen by one narrow aggregate over
    the last `candidate_days` before anything wide is computed or shuffled."""
    if ctx.partials is not None:
        partials = ctx.partials.join(candidates(ctx), "user_id", "left_semi")
        return replace(ctx, partials=partials, actions=ctx.candidate_actions)
    if ctx.candidate_actions is not None:
        return replace(ctx, actions=ctx.candidate_actions)
    return replace(ctx, actions=ctx.actions.join(candidates(ctx), "user_id", "left_semi"))


# Log columns that no feature reads.
UNREAD = ("ts", "value", "model_id")


def stage_candidates(ctx: FeatureContext) -> FeatureContext:
    """The context with the candidates' part of the log written to the shared folder, for a single table. (Tables
    of several splits share partial rows instead, see `partials`.)

    The log is scanned twice: the last `candidate_days` for the candidates, and the reach of the features for
    their rows. All user, pair and brand blocks then read those rows, which are a small part of the log.
    """
    if ctx.partials is not None or ctx.candidate_actions is not None:
        return ctx
    rows = of_candidates(ctx).actions
    return replace(ctx, candidate_actions=stage_actions(rows, reach(ctx), UNREAD))


def reach(ctx: FeatureContext) -> WindowSpec:
    """What the user, pair and brand blocks of a context read of the log."""
    seconds = max(ctx.window.seconds, MOST_DAYS * DAY, int(ctx.candidate_days * DAY))
    return WindowSpec(ctx.end - timedelta(seconds=seconds), ctx.end)


def recent_non_buyers(block: DataFrame) -> DataFrame:
    """Users active in the target category in the last `candidate_days` who did not buy there."""
    return block.filter("c_rows_lately > 0 AND c_buys_lately = 0")


# --- column groups over the user block ---------------------------------------------------------


def day_ratio_columns() -> Exprs:
    return {
        "user_days": "u_days_full",
        "user_days_7d": "u_days_7d",
        "user_days_15d": "u_days_15d",
        "cate_days_7d": "c_days_7d",
        "cate_days_15d": "c_days_15d",
        "user_day_ratio_7d": ratio_zero_as_one("u_days_7d", "u_days_full"),
        "user_day_ratio_15d": ratio_zero_as_one("u_days_15d", "u_days_full"),
        "cate_day_ratio_7d": ratio_zero_as_one("c_days_7d", "u_days_7d"),
        "cate_day_ratio_15d": ratio_zero_as_one("c_days_15d", "u_days_15d"),
    }


def attention_columns() -> Exprs:
    columns: Exprs = {}
    for w in ("7d", "15d", "full"):
        columns[f"user_total_{w}"] = f"u_total_{w}"
        columns[f"cate_total_{w}"] = f"c_total_{w}"
        columns[f"cate_attention_{w}"] = ratio_zero_as_one(f"c_total_{w}", f"u_total_{w}")
    return columns


def daily_mean_columns() -> Exprs:
    return {
        "cate_mean_per_day": ratio_zero_as_one("c_total_7d", "c_days_7d"),
        **{
            f"cate_tz_{z}_per_day": ratio_zero_as_one(f"c_tz_{z}_7d", "c_days_7d") for z in TIME_ZONES
        },
    }


def browse_click_columns() -> Exprs:
    return {"cate_browse_click_15d": ratio_zero_as_one("c_browse_15d", "c_click_15d")}


def sequence_columns(measures: tuple[str, ...] = ("dwell", "runs")) -> Exprs:
    """Category value, user value and their ratio; NULL for a window without a row of the category."""
    columns: Exprs = {}
    for m in measures:
        for d in SEQUENCE_DAYS:
            of_cate, of_user = f"cate_{m}_{d}d", f"{m}_{d}d"
            columns[of_cate] = of_cate
            columns[f"user_{m}_{d}d"] = f"if({of_cate} IS NULL, NULL, {of_user})"
            columns[f"{m}_ratio_{d}d"] = ratio_zero_as_one(of_cate, of_user)
    return columns


def rule_columns() -> Exprs:
    hit = (
        f"c_cnt_{CART}_7d > 0 AND c_cnt_{BUY}_7d = 0"
        f" AND {ratio_or_one('c_browse_7d', 'c_browse_full')} >= 1"
        f" AND {ratio_or_one(f'c_cnt_{BUY}_7d', 'c_buys_full')} >= 1"
        f" AND c_days_7d <= {RULE_DAYS} AND user_lv_cd > {RULE_LEVEL}"
    )
    return {"rule_user": f"if({hit}, 1, 0)"}


# --- the blocks on their own -------------------------------------------------------------------


def user_day_ratios(ctx: FeatureContext) -> DataFrame:
    return project(user_block(ctx).filter("u_rows_full > 0"), USER, day_ratio_columns())


def user_cate_attention(ctx: FeatureContext) -> DataFrame:
    return project(user_block(ctx).filter("u_rows_full > 0"), USER, attention_columns())


def uc_daily_means(ctx: FeatureContext) -> DataFrame:
    return project(user_block(ctx).filter("c_total_7d > 0"), USER, daily_mean_columns())


def uc_browse_click(ctx: FeatureContext) -> DataFrame:
    return project(user_block(ctx).filter("c_total_15d > 0"), USER, browse_click_columns())


def sequence_block(ctx: FeatureContext) -> DataFrame:
    spans = Suffixes.days(ctx.end, SEQUENCE_DAYS)
    return user_sequence_block(ctx.actions, spans, ctx.cate, ctx.max_gap, burst_label="7d")


def user_dwell_ratios(ctx: FeatureContext) -> DataFrame:
    """Dwell in the category over all dwell, for users with a row of the category in the last week."""
    rows = sequence_block(ctx).filter("cate_dwell_7d IS NOT NULL")
    return project(rows, USER, sequence_columns(("dwell",)))


def other_categories_bought(ctx: FeatureContext) -> DataFrame:
    """Number of other categories bought in the last week, for users with rows in another category."""
    rows = scan_window(ctx.actions, ctx.window.back(days=7)).filter(f"cate <> {int(ctx.cate)}")
    per_cate = aggregate(rows, ["user_id", "cate"], {"bought": f"max(if({is_type(BUY)}, 1, 0))"})
    return aggregate(per_cate, USER, {"other_cates_bought_7d": "sum(bought)"})


def _other_purchases(ctx: FeatureContext) -> DataFrame:
    rows = scan_window(ctx.counted, ctx.window.back(days=7))
    buys = rows.filter(f"cate <> {int(ctx.cate)} AND {is_type(BUY)}")
    return buys.groupBy("user_id").agg(F.count_distinct("cate").alias("other_bought"))


def user_feature_columns() -> Exprs:
    """The 71 features over a user block joined with sequences, other purchases and attributes."""
    return {
        "user_lv_cd": "user_lv_cd",
        "reg_days": "reg_days",
        **rule_columns(),
        "user_last_dist": "u_last_dist",
        "user_first_dist": "u_first_dist",
        "cate_last_dist": "c_last_dist",
        **day_ratio_columns(),
        **attention_columns(),
        "max_burst": "max_burst",
        "mean_burst": "mean_burst",
        **sequence_columns(),
        **{f"cate_decay_{t}": f"c_decay_{t}_15d" for t in NON_BUY_TYPES},
        **{f"cate_cnt_{t}_7d": f"c_cnt_{t}_7d" for t in CATE_COUNT_TYPES},
        **daily_mean_columns(),
        "other_cates_bought_7d": "if(o_rows_7d > 0, coalesce(other_bought, 0), NULL)",
        **browse_click_columns(),
    }


def candidate_user_frame(ctx: FeatureContext) -> DataFrame:
    """The user block of the candidates with sequences, other purchases and attributes joined on."""
    base = user_base(ctx.users, ctx.end, ctx.default_reg, ctx.reg_cutoff)
    ctx = of_candidates(ctx)
    return (
        recent_non_buyers(user_block(ctx))
        .join(sequence_block(ctx), "user_id", "left")
        .join(_other_purchases(ctx), "user_id", "left")
        .join(base, "user_id", "left")
    )


def user_features(ctx: FeatureContext, positives: DataFrame | None = None) -> DataFrame:
    """Candidate users with 71 features; `label` when positives are given. Absent values are NULL."""
    features = project(candidate_user_frame(ctx), USER, user_feature_columns())
    return features if positives is None else with_label(features, positives, USER)
