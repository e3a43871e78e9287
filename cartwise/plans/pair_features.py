"""User-item, user-brand, item and brand features, and the assembled pair tables.

The pair aggregate reads rows of the target category only: an item has one category, so every row of a
candidate pair is among them. User-level denominators come from the shared user block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwise.functions.aggregates import is_type
from cartwise.functions.exprs import Exprs, aggregate, project
from cartwise.functions.joins import lookup_join
from cartwise.functions.ratios import ratio_zero_as_one, zero_fill
from cartwise.operators import items as item_ops
from cartwise.operators.labels import with_label
from cartwise.operators.rollup import (
    days_where,
    oldest_where,
    rollup,
    rows_where,
    weights_where,
    within,
    youngest_where,
)
from cartwise.operators.sequence import dwell_multi, visit_runs_multi
from cartwise.plans import user_features as uf
from cartwise.plans.context import FeatureContext
from cartwise.schema import NON_BUY_TYPES, ActionType
from cartwise.windows import DAY, HOUR, Suffixes, WindowSpec

BROWSE, CART, DELCART, CLICK = (
    int(ActionType.BROWSE),
    int(ActionType.CART),
    int(ActionType.DELCART),
    int(ActionType.CLICK),
)

# Window lengths.
COUNT_HOURS = (4, 8, 16, 24, 48, 72, 120, 168, 360, 672)
RUN_HOURS = (4, 8, 16, 24, 48, 72, 120, 168)
TOTAL_DAYS = (1, 2, 3, 5, 7, 15, 28)
RATIO_DAYS = ("7d", "15d", "28d", "full")
DWELL_DAYS = (1, 2, 3, 5, 7)
BRAND_DAYS = (1, 3, 5, 7, 10, 14, 28)
LAST_TYPES = (2, 3, 5)
TOP_N = 5

PAIR = ["user_id", "sku_id"]


def pair_block(ctx: FeatureContext) -> DataFrame:
    """One row per (user, item) of the target category with every additive measure.

    Whether a pair occurs in a window is a comparison on `p_age`, its smallest age.
    """
    hours = Suffixes.hours(ctx.end, COUNT_HOURS)
    days = Suffixes.days(ctx.end, (*TOTAL_DAYS, ctx.candidate_days), ctx.window)
    both = Suffixes(ctx.end, hours.spans + days.spans)
    longest = max(seconds for _, seconds in both.spans)
    full, month = within(days, "full"), within(days, "28d")
    exprs: Exprs = {
        "cate": f"{int(ctx.cate)}",
        "brand": "max(brand)",
        "p_age": "min(nearest)",
        "p_first": oldest_where(full),
        "p_last": youngest_where(full),
        "p_carts_full": rows_where(is_type(CART), full),
    }
    for w in days.labels:
        exprs[f"p_days_{w}"] = days_where(ctx.end, longest, within(days, w))
    for d in TOTAL_DAYS:
        exprs[f"p_total_{d}d"] = rows_where(within(days, f"{d}d"))
    for w in hours.labels:
        for t in NON_BUY_TYPES:
            exprs[f"p_cnt_{t}_{w}"] = rows_where(is_type(t), within(hours, w))
    for t in LAST_TYPES:
        exprs[f"p_last_{t}"] = youngest_where(is_type(t), full)
    if ctx.curve is not None:
        exprs["p_decay"] = weights_where(month)
        for t in NON_BUY_TYPES:
            exprs[f"p_decay_{t}"] = weights_where(is_type(t), month)
    rows = ctx.weighted(both.scan(ctx.counted, ctx.cate))
    return aggregate(rollup(rows, both, PAIR, ["brand"], ctx.placed), PAIR, exprs)


def _if_seen(seconds: int, sql: str) -> str:
    return f"if(p_age <= {seconds}, {sql}, NULL)"


def _seen(block: DataFrame, seconds: float) -> DataFrame:
    return block.filter(f"p_age <= {int(seconds)}")


# --- column groups over pair block (+ user block) ----------------------------------------------


def span_columns() -> Exprs:
    return {
        "pair_first_dist": "p_first",
        "pair_last_dist": "p_last",
        "pair_span": "p_first - p_last",
    }


def day_columns() -> Exprs:
    return {
        **{f"pair_days_{w}": f"p_days_{w}" for w in RATIO_DAYS},
        **{
            f"pair_day_ratio_{w}": ratio_zero_as_one(f"p_days_{w}", f"u_days_{w}") for w in RATIO_DAYS
        },
    }


def count_columns() -> Exprs:
    return {
        f"pair_cnt_{t}_{h}h": _if_seen(h * HOUR, f"p_cnt_{t}_{h}h")
        for h in COUNT_HOURS
        for t in NON_BUY_TYPES
    }


def total_columns() -> Exprs:
    columns: Exprs = {}
    for d in TOTAL_DAYS:
        pair, cate, days = f"p_total_{d}d", f"c_total_{d}d", f"p_days_{d}d"
        columns[f"cate_total_{d}d"] = _if_seen(d * DAY, cate)
        columns[f"pair_total_{d}d"] = _if_seen(d * DAY, pair)
        columns[f"pair_share_{d}d"] = _if_seen(d * DAY, ratio_zero_as_one(pair, cate))
        columns[f"pair_mean_{d}d"] = _if_seen(d * DAY, ratio_zero_as_one(pair, days))
    return columns


def dwell_columns() -> Exprs:
    columns: Exprs = {}
    for d in DWELL_DAYS:
        pair, cate = f"dwell_{d}d", f"coalesce(cate_dwell_{d}d, 0)"
        columns[f"pair_dwell_{d}d"] = pair
        columns[f"pair_cate_dwell_{d}d"] = f"if({pair} IS NULL, NULL, {cate})"
        columns[f"pair_dwell_ratio_{d}d"] = ratio_zero_as_one(pair, cate)
    return columns


def browse_click_columns() -> Exprs:
    ratio = ratio_zero_as_one(f"p_cnt_{BROWSE}_168h", f"p_cnt_{CLICK}_168h")
    return {"pair_browse_click_7d": _if_seen(7 * DAY, ratio)}


def run_columns() -> Exprs:
    return {f"pair_runs_{h}h": f"runs_{h}h" for h in RUN_HOURS}


def last_type_columns() -> Exprs:
    columns = {f"pair_last_{t}": f"coalesce(p_last_{t}, 0)" for t in LAST_TYPES}
    later = f"{columns[f'pair_last_{CART}']} > {columns[f'pair_last_{DELCART}']}"
    return {**columns, "pair_delcart_later": f"if({later}, 1, 0)"}


def cart_share_columns() -> Exprs:
    return {"pair_cart_share": ratio_zero_as_one("p_carts_full", "u_carts_full")}


def pair_feature_columns() -> Exprs:
    """The 127 pair features."""
    return {
        **span_columns(),
        **day_columns(),
        "pair_decay": _if_seen(28 * DAY, "p_decay"),
        **{f"pair_has_{t}": f"if(p_last_{t} IS NULL, 0, 1)" for t in LAST_TYPES},
        **count_columns(),
        **total_columns(),
        **dwell_columns(),
        **browse_click_columns(),
        **run_columns(),
        **last_type_columns(),
        **{f"pair_decay_{t}": _if_seen(28 * DAY, f"p_decay_{t}") for t in NON_BUY_TYPES},
        **cart_share_columns(),
    }


# --- the blocks on their own -------------------------------------------------------------------


def _full_pairs(ctx: FeatureContext) -> DataFrame:
    return _seen(pair_block(ctx), ctx.window.seconds)


def ui_span(ctx: FeatureContext) -> DataFrame:
    return project(_full_pairs(ctx), PAIR, span_columns())


def ui_day_ratios(ctx: FeatureContext) -> DataFrame:
    return project(_full_pairs(ctx).join(uf.user_block(ctx), "user_id", "left"), PAIR, day_columns())


def ui_uc_totals(ctx: FeatureContext) -> DataFrame:
    pairs = _seen(pair_block(ctx), TOTAL_DAYS[-1] * DAY)
    return project(pairs.join(uf.user_block(ctx), "user_id", "left"), PAIR, total_columns())


def _pair_dwell(ctx: FeatureContext) -> DataFrame:
    return dwell_multi(ctx.actions, Suffixes.days(ctx.end, DWELL_DAYS), PAIR, ctx.max_gap, ctx.cate)


def cate_dwell(ctx: FeatureContext) -> DataFrame:
    spans = Suffixes.days(ctx.end, DWELL_DAYS)
    dwell = dwell_multi(ctx.actions, spans, ["user_id"], ctx.max_gap, ctx.cate)
    return project(dwell, ["user_id"], {f"cate_dwell_{w}": f"dwell_{w}" for w in spans.labels})


def ui_dwell_ratios(ctx: FeatureContext) -> DataFrame:
    return project(_pair_dwell(ctx).join(cate_dwell(ctx), "user_id", "left"), PAIR, dwell_columns())


def _pair_runs(ctx: FeatureContext) -> DataFrame:
    return visit_runs_multi(ctx.actions, Suffixes.hours(ctx.end, RUN_HOURS), ctx.cate)


def ui_runs_multi(ctx: FeatureContext) -> DataFrame:
    return project(_pair_runs(ctx), PAIR, run_columns())


def ui_delcart_later(ctx: FeatureContext) -> DataFrame:
    return project(_full_pairs(ctx), PAIR, last_type_columns())


def ui_cart_share(ctx: FeatureContext) -> DataFrame:
    joined = _full_pairs(ctx).join(uf.user_block(ctx), "user_id", "left")
    return project(joined, PAIR, cart_share_columns())


def ui_browse_click(ctx: FeatureContext) -> DataFrame:
    return project(_seen(pair_block(ctx), 7 * DAY), PAIR, browse_click_columns())


def _brand_block(ctx: FeatureContext) -> DataFrame:
    s = Suffixes.days(ctx.end, BRAND_DAYS)
    keys, totals = ["user_id", "brand"], {f"ub_total_{w}": rows_where(within(s, w)) for w in s.labels}
    return aggregate(rollup(s.scan(ctx.counted), s, keys, [], ctx.placed), keys, {"ub_age": "min(nearest)", **totals})


def brand_share_columns() -> Exprs:
    return {
        f"brand_share_{d}d": f"if(ub_age <= {d * DAY}, "
        + ratio_zero_as_one(f"ub_total_{d}d", f"u_total_{d}d")
        + ", NULL)"
        for d in BRAND_DAYS
    }


def ub_share(ctx: FeatureContext) -> DataFrame:
    joined = _brand_block(ctx).join(uf.user_block(ctx), "user_id", "left")
    return project(joined, ["user_id", "brand"], brand_share_columns())


def item_table(ctx: FeatureContext) -> DataFrame:
    """Flow, attribute, comment and best-seller columns, one row per item seen in the window."""
    top = item_ops.top_by_buys(ctx.counted, ctx.window.back(days=7), ctx.cate, "sku_id", TOP_N)
    known = (
        item_ops.flow_ratios(ctx.counted, ctx.window)
        .join(item_ops.attribute_onehot(ctx.products), "sku_id", "left")
        .join(item_ops.comment_snapshot(ctx.comments, ctx.end), "sku_id", "left")
    )
    return item_ops.flag_top(known, top, "sku_id", "top_item")


def brand_table(ctx: FeatureContext) -> DataFrame:
    """Bad-comment rate and best-seller flag, one row per brand with either."""
    top = item_ops.top_by_buys(ctx.counted, ctx.window.back(days=7), ctx.cate, "brand", TOP_N)
    history = WindowSpec(ctx.log_start or ctx.window.start, ctx.end)
    rates = item_ops.brand_bad_rate(ctx.counted, history, ctx.comments)
    flagged = top.selectExpr("brand", "1 AS top_brand")
    return rates.join(flagged, "brand", "full")


def add_item_features(df: DataFrame, items: DataFrame) -> DataFrame:
    """Item columns on (user, item) rows; items without an entry are no best-sellers."""
    joined = lookup_join(df, items, "sku_id", ["user_id"])
    return joined.fillna(0, subset=["top_item"])


def add_brand_features(df: DataFrame, ctx: FeatureContext) -> DataFrame:
    """Brand columns on (user, item) rows."""
    joined = lookup_join(df, brand_table(ctx), "brand", ["user_id", "sku_id"])
    return joined.fillna(0, subset=["top_brand"])


# --- assembled tables -------------------------------------------------------------------------


def _candidate_pairs(ctx: FeatureContext) -> DataFrame:
    """Pair block of the candidate users' pairs seen lately, with dwell and runs, all keyed by (user, item)."""
    ctx = uf.of_candidates(ctx)
    recent = _seen(pair_block(ctx), ctx.candidate_days * DAY)
    return recent.join(_pair_dwell(ctx), PAIR, "left").join(_pair_runs(ctx), PAIR, "left")


def _user_side(ctx: FeatureContext) -> DataFrame:
    """Candidate users with the denominators of the pair features."""
    ctx = uf.of_candidates(ctx)
    return uf.recent_non_buyers(uf.user_block(ctx)).join(cate_dwell(ctx), "user_id", "left")


def _label(df: DataFrame, positives: DataFrame | None) -> DataFrame:
    return df if positives is None else with_label(df, positives, PAIR)


_KEYS = ["user_id", "sku_id", "cate", "brand"]


def pair_features(ctx: FeatureContext, positives: DataFrame | None = None) -> DataFrame:
    """Candidate pairs with 127 features. Values of windows without a row are NULL."""
    ctx = uf.stage_candidates(ctx)
    joined = _candidate_pairs(ctx).join(_user_side(ctx), "user_id")
    return _label(project(joined, _KEYS, pair_feature_columns()), positives)


def _assembled(ctx: FeatureContext, users: DataFrame, extra: Exprs) -> DataFrame:
    """Pairs -> brand shares -> item -> brand -> user, each side assembled to one row per key first.

    Only candidate rows move between the joins. A user owns at most the category's items; adaptive execution
    broadcasts small item and brand tables and splits a join on a hot key.
    """
    pairs = _candidate_pairs(ctx).join(_brand_block(uf.of_candidates(ctx)), ["user_id", "brand"], "left")
    if ctx.guard is not None:
        pairs = ctx.guard.before(pairs)
    items = item_table(ctx).join(item_ops.sale_ratios(ctx.counted, ctx.end), "sku_id", "left")
    with_items = add_item_features(pairs, items)
    joined = add_brand_features(with_items, ctx).join(users, "user_id")
    if ctx.guard is not None:
        joined = ctx.guard.after(joined)
    columns = {
        **pair_feature_columns(),
        **brand_share_columns(),
        **{c: c for c in _item_columns()},
        **{c: c for c in ("top_item", "brand_bad_rate", "top_brand")},
        **{c: c for c in (f"sale_ratio_{d}d" for d in item_ops.SALE_DAYS)},
        **extra,
    }
    return project(joined, _KEYS, columns)


def _item_columns() -> list[str]:
    onehot = [f"{a}_{v}" for a, domain in item_ops.ATTRIBUTE_VALUES.items() for v in domain]
    comments = [f"comment_num_{c}" for c in item_ops.COMMENT_CLASSES]
    flows = [f"flow_ratio_{d}d" for d in item_ops.FLOW_DAYS]
    return [*flows, *onehot, "has_bad_comment", "bad_comment_rate", *comments]


def sku_features(ctx: FeatureContext, positives: DataFrame | None = None) -> DataFrame:
    """Candidate pairs with pair, brand, item and sales features; absent values are 0."""
    ctx = uf.stage_candidates(ctx)
    return zero_fill(_label(_assembled(ctx, _user_side(ctx), {}), positives))


USER_PREFIX = "user__"


def training_table(ctx: FeatureContext, positives: DataFrame | None = None) -> DataFrame:
    """Pair table with the user features of the same split (prefixed `user__`) on every row.

    Pair denominators and user features are columns of one user frame, so the user side is computed and
    joined once. User features keep their NULLs.
    """
    ctx = uf.stage_candidates(ctx)
    denominators = [
        "u_carts_full",
        *[f"u_days_{w}" for w in RATIO_DAYS],
        *[f"u_total_{d}d" for d in BRAND_DAYS],
        *[f"c_total_{d}d" for d in TOTAL_DAYS],
        *[f"cate_dwell_{d}d" for d in DWELL_DAYS],
    ]
    features = {USER_PREFIX + name: sql for name, sql in uf.user_feature_columns().items()}
    users = project(uf.candidate_user_frame(ctx), ["user_id", *denominators], features)
    table = _label(_assembled(ctx, users, {c: c for c in features}), positives)
    return zero_fill(table, [c for c in table.columns if c not in features])
