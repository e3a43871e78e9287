"""Item, brand and comment features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.aggregates import is_type, rows_of
from cartwise.functions.exprs import aggregate, project
from cartwise.functions.ratios import ratio_zero_as_one
from cartwise.operators.distinct import people_flow_multi
from cartwise.operators.labels import with_label
from cartwise.schema import ActionType
from cartwise.windows import Suffixes, WindowSpec, scan_window

BUY = int(ActionType.BUY)

# Comment-count classes and product attribute values (0 stands for unknown).
COMMENT_CLASSES = (0, 1, 2, 3, 4)
ATTRIBUTE_VALUES = {"a1": (0, 1, 2, 3), "a2": (0, 1, 2), "a3": (0, 1, 2)}
FLOW_DAYS = (1, 3, 5, 7, 10, 15, 28)
SALE_DAYS = (1, 2, 3, 5, 7, 10, 14, 28)


def comment_snapshot(comments: DataFrame, end: datetime) -> DataFrame:
    """The latest snapshot dated before `end`, with the comment class one-hot encoded."""
    before = comments.filter(F.col("dt") < F.lit(end).cast("timestamp_ntz"))
    latest = before.agg(F.max("dt").alias("dt"))  # one row
    return before.join(F.broadcast(latest), "dt").select(
        "sku_id",
        "has_bad_comment",
        "bad_comment_rate",
        *[
            F.when(F.col("comment_num") == c, 1).otherwise(0).alias(f"comment_num_{c}")
            for c in COMMENT_CLASSES
        ],
    )


def attribute_onehot(products: DataFrame, values: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """`<attribute>_<value>` 0/1 columns; -1 (unknown) is encoded as value 0."""
    columns = []
    for name, domain in (values or ATTRIBUTE_VALUES).items():
        known = F.when(F.col(name) == -1, 0).otherwise(F.col(name))
        columns += [F.when(known == v, 1).otherwise(0).alias(f"{name}_{v}") for v in domain]
    return products.select("sku_id", *columns)


def top_by_buys(actions: DataFrame, window: WindowSpec, cate: int, key: str, n: int = 5) -> DataFrame:
    """The `n` keys with most buys in the category; ties go to the lower key."""
    buys = scan_window(actions, window, cate).filter(F.col("type") == BUY)
    return (
        buys.groupBy(key)
        .agg(F.expr(rows_of(actions)).alias("buys"))
        .orderBy(F.desc("buys"), key)
        .limit(n)
        .select(key)
    )


def flag_top(df: DataFrame, top: DataFrame, key: str, name: str) -> DataFrame:
    """0/1 column `name`: whether the key is in the (top-n sized) list."""
    return with_label(df, top, [key], name)


def flow_ratios(actions: DataFrame, full: WindowSpec, days=FLOW_DAYS) -> DataFrame:
    """`flow_ratio_<d>d`: distinct users of the last d days over those of the full window, per item."""
    # Items are those of the full window, so users seen only before its start do not count.
    flows = people_flow_multi(actions, Suffixes.days(full.end, days, full), "sku_id")
    ratios = {f"flow_ratio_{d}d": ratio_zero_as_one(f"flow_{d}d", "flow_full") for d in days}
    return project(flows.filter("flow_full > 0"), ["sku_id"], ratios)


def brand_bad_rate(actions: DataFrame, window: WindowSpec, comments: DataFrame) -> DataFrame:
    """Mean bad-comment rate over the brand's commented items."""
    rates = comment_snapshot(comments, window.end).select("sku_id", "bad_comment_rate")
    brands = scan_window(actions, window, columns=["sku_id", "brand"]).distinct()
    return (
        rates.join(brands, "sku_id")
        .groupBy("brand")
        .agg(F.avg("bad_comment_rate").alias("brand_bad_rate"))
        .filter(F.col("brand").isNotNull())
    )


def sale_ratios(actions: DataFrame, end: datetime, days=SALE_DAYS) -> DataFrame:
    """`sale_ratio_<d>d`: item's buys over the buys of its (brand, category), per item.

    NULL where the item has no row in the last d days. Category-brand sums are rolled up from the item
    sums, so the log is aggregated once.
    """
    suffixes = Suffixes.days(end, days)
    buys = {f"buys_{w}": rows_of(actions, is_type(BUY), suffixes.within(w)) for w in suffixes.labels}
    items = aggregate(
        suffixes.scan(actions), ["sku_id", "cate", "brand"], {"age": "min(age)", **buys}
    )
    groups = aggregate(
        items, ["cate", "brand"], {f"group_{name}": f"sum({name})" for name in buys}
    )
    ratios = {
        f"sale_ratio_{w}": f"if({suffixes.within(w)}, "
        + ratio_zero_as_one(f"buys_{w}", f"coalesce(group_buys_{w}, 0)")
        + ", NULL)"
        for w in suffixes.labels
    }
    return project(items.join(groups, ["cate", "brand"], "left"), ["sku_id"], ratios)
