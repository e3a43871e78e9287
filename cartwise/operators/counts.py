"""Action counts per key: by type, by quarter of the day, by calendar day; totals, flags and ratios."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame

from cartwise.functions.aggregates import count_where, is_type
from cartwise.functions.exprs import aggregate, project
from cartwise.functions.ratios import ratio_or_null, ratio_or_one
from cartwise.operators.rollup import rollup, rows_where, within
from cartwise.schema import ALL_TYPES, NON_BUY_TYPES, TIME_ZONES, USER_TOTAL_TYPES, ActionType
from cartwise.windows import Suffixes, WindowSpec, scan_window


def action_counts(
    actions: DataFrame, window: WindowSpec, keys: list[str], types=ALL_TYPES, cate: int | None = None
) -> DataFrame:
    """`cnt_<type>` per key. A key is present once it has any row in the window."""
    rows = scan_window(actions, window, cate)
    return aggregate(rows, keys, {f"cnt_{t}": count_where(is_type(t)) for t in types})


def action_counts_multi(
    actions: DataFrame, suffixes: Suffixes, keys: list[str], types=ALL_TYPES, cate: int | None = None
) -> DataFrame:
    """`cnt_<type>_<window>` for many trailing windows in one pass over counts per type and age band.

    A window in which the key has no row at all gives NULL, as an absent key would after a left join.
    """
    exprs = {}
    for label in suffixes.labels:
        seen = within(suffixes, label)
        for t in types:
            exprs[f"cnt_{t}_{label}"] = f"if(max({seen}), {rows_where(is_type(t), seen)}, NULL)"
    return aggregate(rollup(suffixes.scan(actions, cate), suffixes, keys, []), keys, exprs)


def time_zone_counts(
    actions: DataFrame, window: WindowSpec, keys: list[str], cate: int | None = None
) -> DataFrame:
    """`tz_<0..3>`: rows per quarter of the day."""
    rows = scan_window(actions, window, cate)
    return aggregate(rows, keys, {f"tz_{z}": count_where(f"time_zone = {z}") for z in TIME_ZONES})


def login_matrix(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """One 0/1 column `login_<yyyy-mm-dd>` per calendar day of the window, one row per user."""
    first, last = window.start.date(), (window.end - timedelta(microseconds=1)).date()
    days = [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    flags = {f"login_{d}": f"max(if(to_date(time) = DATE'{d}', 1, 0))" for d in days}
    return aggregate(scan_window(actions, window), ["user_id"], flags)


def total_counts(
    actions: DataFrame, window: WindowSpec, keys: list[str], types=None, cate: int | None = None
) -> DataFrame:
    """`total_cnt` per key over `types` (all when None)."""
    rows = scan_window(actions, window, cate)
    total = "count(1)" if types is None else count_where(is_type(*types))
    return aggregate(rows, keys, {"total_cnt": total})


def user_total_counts(actions: DataFrame, window: WindowSpec, types=USER_TOTAL_TYPES) -> DataFrame:
    return total_counts(actions, window, ["user_id"], types)


def action_flags(
    actions: DataFrame, window: WindowSpec, keys: list[str], types=ALL_TYPES, cate: int | None = None
) -> DataFrame:
    """`has_<type>` 0/1 per key."""
    rows = scan_window(actions, window, cate)
    return aggregate(rows, keys, {f"has_{t}": f"max(if({is_type(t)}, 1, 0))" for t in types})


def buy_conversion(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """Buys over each other action type per user; an undefined quotient counts as 1."""
    counts = action_counts(actions, window, ["user_id"])
    buys = f"cnt_{int(ActionType.BUY)}"
    return project(
        counts, ["user_id"], {f"buy_per_{t}": ratio_or_one(buys, f"cnt_{t}") for t in NON_BUY_TYPES}
    )


def _nested_counts(
    rows: DataFrame, keys: list[str], window: WindowSpec, sub: WindowSpec, also: str | None = None
) -> DataFrame:
    """`all_<type>` over the rows and `sub_<type>` over those in `sub`, for keys with a row in `sub`."""
    if not (window.start <= sub.start and sub.end <= window.end):
        raise ValueError("the sub-window must lie inside the window")
    inner = sub.where() if also is None else f"{sub.where()} AND {also}"
    exprs = {"seen": f"max({inner})"}
    for t in ALL_TYPES:
        exprs[f"all_{t}"] = count_where(is_type(t))
        exprs[f"sub_{t}"] = count_where(is_type(t), inner)
    return aggregate(rows, keys, exprs).filter("seen")


def window_ratios(
    actions: DataFrame, window: WindowSpec, sub: WindowSpec, keys: list[str], cate: int | None = None
) -> DataFrame:
    """Share of each type's rows that falls into `sub`, a part of `window`, per key seen in `sub`.

    Both counts come from one scan of `window`; an undefined quotient counts as 1.
    """
    counts = _nested_counts(scan_window(actions, window, cate), keys, window, sub)
    return project(
        counts, keys, {f"ratio_{t}": ratio_or_one(f"sub_{t}", f"all_{t}") for t in ALL_TYPES}
    )


def cate_share_of_user(
    actions: DataFrame, window: WindowSpec, sub: WindowSpec, cate: int
) -> DataFrame:
    """Rows of the user in one category inside `sub` over all rows of the user in `window`, by type.

    Undefined quotients stay NULL.
    """
    rows = scan_window(actions, window)
    counts = _nested_counts(rows, ["user_id"], window, sub, f"cate = {int(cate)}")
    ratios = {f"ratio_{t}": ratio_or_null(f"sub_{t}", f"all_{t}") for t in ALL_TYPES}
    return project(counts, ["user_id"], {"cate": str(int(cate)), **ratios})


def item_share_of_cate(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """Rows of (user, item) over rows of (user, category) by type; undefined counts as 1.

    The category totals are rolled up from the item counts, so only grouped rows are joined.
    """
    items = action_counts(actions, window, ["user_id", "sku_id", "cate"])
    cates = aggregate(
        items, ["user_id", "cate"], {f"cate_cnt_{t}": f"sum(cnt_{t})" for t in ALL_TYPES}
    )
    return project(
        items.join(cates, ["user_id", "cate"]),
        ["user_id", "sku_id"],
        {f"share_{t}": ratio_or_one(f"cnt_{t}", f"cate_cnt_{t}") for t in ALL_TYPES},
    )
