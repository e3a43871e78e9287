"""Exact distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions import aggregates
from cartwise.functions.aggregates import count_where, is_type
from cartwise.functions.exprs import aggregate, project
from cartwise.schema import ALL_TYPES
from cartwise.windows import Suffixes, WindowSpec, scan_window


def active_days(
    actions: DataFrame, window: WindowSpec, keys: list[str], cate: int | None = None
) -> DataFrame:
    """`day_cnt`: calendar days with at least one row, per key."""
    rows = scan_window(actions, window, cate)
    return aggregate(rows, keys, {"day_cnt": aggregates.active_days(window.end, window.seconds)})


def active_days_multi(
    actions: DataFrame, suffixes: Suffixes, keys: list[str], cate: int | None = None
) -> DataFrame:
    """`day_cnt_<window>` for many trailing windows in one pass (0 where the key has no row)."""
    exprs = {
        f"day_cnt_{label}": aggregates.active_days(suffixes.end, seconds, suffixes.within(label))
        for label, seconds in suffixes.spans
    }
    return aggregate(suffixes.scan(actions, cate), keys, exprs)


def distinct_count(
    actions: DataFrame, window: WindowSpec, keys: list[str], column: str, name: str, cate: int | None = None
) -> DataFrame:
    """Exact distinct non-null values of `column` per key."""
    rows = scan_window(actions, window, cate).filter(F.col(column).isNotNull())
    return rows.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def people_flow_multi(actions: DataFrame, suffixes: Suffixes, key: str) -> DataFrame:
    """`flow_<window>`: distinct users per `key` in many trailing windows.

    Each (key, user) keeps its smallest age; it belongs to every window at least that long.
    """
    latest = suffixes.scan(actions).groupBy(key, "user_id").agg(F.min("age").alias("age"))
    flows = {f"flow_{label}": count_where(suffixes.within(label)) for label in suffixes.labels}
    return aggregate(latest, [key], flows)


def distinct_items_by_type(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """`items_<type>`: distinct items per (user, category) and action type, 0 where none.

    Items are reduced to one row of per-type flags first, so six distinct counts cost one pass.
    """
    flags = aggregate(
        scan_window(actions, window),
        ["user_id", "cate", "sku_id"],
        {f"has_{t}": f"max(if({is_type(t)}, 1, 0))" for t in ALL_TYPES},
    )
    return aggregate(flags, ["user_id", "cate"], {f"items_{t}": f"sum(has_{t})" for t in ALL_TYPES})


def only_category(actions: DataFrame, window: WindowSpec, cate: int) -> DataFrame:
    """For users with rows of `cate`: 1 when it is their only category in the window."""
    users = aggregate(
        scan_window(actions, window),
        ["user_id"],
        {"lo": "min(cate)", "hi": "max(cate)", "seen": f"max(cate = {int(cate)})"},
    ).filter("seen")
    return project(users, ["user_id"], {"cate": str(int(cate)), "only_cate": "if(lo = hi, 1, 0)"})


def item_category_brand(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """Distinct (item, category, brand)."""
    return scan_window(actions, window, columns=["sku_id", "cate", "brand"]).distinct()
