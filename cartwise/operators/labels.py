"""Labels, candidates, evaluation splits and rule-based selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions import aggregates
from cartwise.functions.aggregates import count_where, is_type
from cartwise.functions.exprs import aggregate
from cartwise.functions.ratios import ratio_or_one
from cartwise.schema import ActionType
from cartwise.windows import WindowSpec, scan_window

BUY, CART, BROWSE = int(ActionType.BUY), int(ActionType.CART), int(ActionType.BROWSE)


def label_pairs(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """Distinct (user, item) bought in the window."""
    buys = scan_window(actions, window).filter(F.col("type") == BUY)
    return buys.select("user_id", "sku_id").distinct()


def label_pairs_known(
    actions: DataFrame, window: WindowSpec, products: DataFrame, users: DataFrame
) -> DataFrame:
    """Bought pairs whose item and user are both listed."""
    return (
        label_pairs(actions, window)
        .join(products.select("sku_id"), "sku_id", "left_semi")
        .join(users.select("user_id"), "user_id", "left_semi")
        .select("user_id", "sku_id")
    )


_PREFIX = 4  # hex digits of the digest that name a bucket: 16**4 = 65,536 buckets


def split_boards(pairs: DataFrame, share: float = 0.5, salt: str = "") -> DataFrame:
    """Adds `board`: exactly ``floor(N * share)`` pairs are B, the rest A, picked by digest order.

    The global rank is the rank inside a digest-prefix bucket plus the sizes of the buckets before it.
    Digests spread evenly, and the bucket table is bounded by the number of prefixes.
    """
    keyed = pairs.withColumn(
        "digest", F.md5(F.concat_ws(":", "user_id", "sku_id", *([F.lit(salt)] if salt else [])))
    ).withColumn("bucket", F.substring("digest", 1, _PREFIX))
    in_order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    offsets = sizes.select(
        "bucket",
        F.coalesce(F.sum("size").over(in_order), F.lit(0)).alias("before"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("digest", "user_id", "sku_id"))
    ranked = keyed.withColumn("inside", inside).join(F.broadcast(offsets), "bucket")
    is_b = F.col("before") + F.col("inside") <= F.floor(F.col("total") * share)
    return ranked.select("user_id", "sku_id", F.when(is_b, "B").otherwise("A").alias("board"))


def eval_split(actions: DataFrame, window: WindowSpec, share: float = 0.5, salt: str = "") -> DataFrame:
    """Bought pairs with an A/B board."""
    return split_boards(label_pairs(actions, window), share, salt)


def one_pair_per_user(pairs: DataFrame) -> DataFrame:
    """The lowest item id of each user."""
    return pairs.groupBy("user_id").agg(F.min("sku_id").alias("sku_id"))


def eval_split_known(
    actions: DataFrame,
    window: WindowSpec,
    products: DataFrame,
    users: DataFrame,
    share: float = 0.5,
    salt: str = "",
) -> DataFrame:
    """Listed bought pairs, one per user, with an A/B board."""
    known = label_pairs_known(actions, window, products, users)
    return split_boards(one_pair_per_user(known), share, salt)


def label_users(
    actions: DataFrame, window: WindowSpec, products: DataFrame, users: DataFrame
) -> DataFrame:
    """Distinct users with a listed bought pair."""
    return label_pairs_known(actions, window, products, users).select("user_id").distinct()


def with_label(df: DataFrame, positives: DataFrame, keys: list[str], name: str = "label") -> DataFrame:
    """Adds a 0/1 column: whether the key occurs in `positives`."""
    marks = positives.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return df.join(marks, keys, "left").withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_hit")


def candidate_users(
    actions: DataFrame, window: WindowSpec, cate: int, days: float = 7, positives: DataFrame | None = None
) -> DataFrame:
    """Users active in `cate` in the last `days` who did not buy there; labelled when possible."""
    recent = scan_window(actions, window.back(days=days), cate)
    users = (
        recent.groupBy("user_id")
        .agg(F.max(F.col("type") == BUY).alias("bought"))
        .filter(~F.col("bought"))
        .select("user_id")
    )
    return users if positives is None else with_label(users, positives, ["user_id"])


def candidate_pairs(
    actions: DataFrame, window: WindowSpec, cate: int, days: float = 7, positives: DataFrame | None = None
) -> DataFrame:
    """Distinct (user, item, category, brand) of the last `days` in `cate`, minus its buyers."""
    recent = scan_window(actions, window.back(days=days), cate)
    buyers = recent.filter(F.col("type") == BUY).select("user_id").distinct()
    pairs = (
        recent.select("user_id", "sku_id", "cate", "brand")
        .distinct()
        .join(buyers, "user_id", "left_anti")
    )
    return pairs if positives is None else with_label(pairs, positives, ["user_id", "sku_id"])


def rule_users(
    actions: DataFrame,
    users: DataFrame,
    window: WindowSpec,
    sub: WindowSpec,
    cate: int,
    min_ratio: float = 1.0,
    above_level: int = 2,
    max_days: int | None = 2,
) -> DataFrame:
    """Users whose interest in `cate` is all recent: carted there but did not buy, high level, few days.

    Browse and buy counts of `sub` over `window` must reach `min_ratio`. One aggregate over the
    category's rows decides everything but the level.
    """
    inner = sub.where()
    seen = aggregate(
        scan_window(actions, window, cate),
        ["user_id"],
        {
            "browse_sub": count_where(is_type(BROWSE), inner),
            "browse_all": count_where(is_type(BROWSE)),
            "buy_sub": count_where(is_type(BUY), inner),
            "buy_all": count_where(is_type(BUY)),
            "cart_sub": count_where(is_type(CART), inner),
            "days_sub": aggregates.active_days(window.end, window.seconds, inner),
        },
    )
    kept = _rule(seen, min_ratio)
    if max_days is not None:
        kept = kept.filter(F.col("days_sub") <= max_days)
    return _above_level(kept, users, above_level)


def rule_users_whole_log(
    actions: DataFrame,
    users: DataFrame,
    window: WindowSpec,
    sub: WindowSpec,
    cate: int,
    min_ratio: float = 1.0,
    above_level: int = 2,
) -> DataFrame:
    """Older rule: ratios over all categories, no limit on active days."""
    inner, here = sub.where(), f"cate = {int(cate)}"
    seen = aggregate(
        scan_window(actions, window),
        ["user_id"],
        {
            "browse_sub": count_where(is_type(BROWSE), inner),
            "browse_all": count_where(is_type(BROWSE)),
            "any_buy_sub": count_where(is_type(BUY), inner),
            "buy_all": count_where(is_type(BUY)),
            "buy_sub": count_where(is_type(BUY), inner, here),
            "cart_sub": count_where(is_type(CART), inner, here),
        },
    )
    return _above_level(_rule(seen, min_ratio, buy_sub="any_buy_sub"), users, above_level)


def _rule(seen: DataFrame, min_ratio: float, buy_sub: str = "buy_sub") -> DataFrame:
    return seen.filter(
        "cart_sub > 0 AND buy_sub = 0"
        f" AND {ratio_or_one('browse_sub', 'browse_all')} >= {float(min_ratio)}D"
        f" AND {ratio_or_one(buy_sub, 'buy_all')} >= {float(min_ratio)}D"
    )


def _above_level(seen: DataFrame, users: DataFrame, above_level: int) -> DataFrame:
    levels = users.filter(F.col("user_lv_cd") > above_level).select("user_id")
    return seen.join(levels, "user_id", "left_semi").select("user_id")


def one_day_buyers(actions: DataFrame, window: WindowSpec) -> DataFrame:
    """Users active on a single day of the window who bought something."""
    users = aggregate(
        scan_window(actions, window),
        ["user_id"],
        {
            "days": aggregates.active_days(window.end, window.seconds),
            "bought": f"max({is_type(BUY)})",
        },
    )
    return users.filter("days = 1 AND bought").select("user_id")
