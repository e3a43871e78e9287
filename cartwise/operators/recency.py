"""Distances in seconds from an action to the window end, and base user attributes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.aggregates import first_where, is_type
from cartwise.functions.exprs import aggregate
from cartwise.schema import ALL_TYPES
from cartwise.windows import DAY, WindowSpec, age_seconds, ntz, scan_window


def _ages(actions: DataFrame, window: WindowSpec, cate: int | None = None) -> DataFrame:
    return scan_window(actions, window, cate).withColumn("age", age_seconds(window.end))


def first_distance(
    actions: DataFrame, window: WindowSpec, keys: list[str], cate: int | None = None
) -> DataFrame:
    """`first_dist`: seconds from the key's earliest row to the window end."""
    return _ages(actions, window, cate).groupBy(*keys).agg(F.max("age").alias("first_dist"))


def last_distance(
    actions: DataFrame, window: WindowSpec, keys: list[str], cate: int | None = None
) -> DataFrame:
    """`last_dist`: seconds from the key's latest row to the window end."""
    return _ages(actions, window, cate).groupBy(*keys).agg(F.min("age").alias("last_dist"))


def last_distance_by_type(
    actions: DataFrame, window: WindowSpec, keys: list[str], types=ALL_TYPES
) -> DataFrame:
    """`last_dist_<type>` per key, NULL for a type the key never had."""
    exprs = {f"last_dist_{t}": first_where("age", is_type(t)) for t in types}
    return aggregate(_ages(actions, window), keys, exprs)


def type_last_distance(
    actions: DataFrame, window: WindowSpec, keys: list[str], action_type: int, cate: int | None = None
) -> DataFrame:
    """`last_dist` over rows of one action type; keys without such a row are absent."""
    return last_distance(actions.filter(F.col("type") == action_type), window, keys, cate)


def type_second_distance(
    actions: DataFrame, window: WindowSpec, keys: list[str], action_type: int, cate: int | None = None
) -> DataFrame:
    """`second_dist`: the second-latest distinct time of one type; keys with one time are absent.

    The rank filter lets Spark drop all but two rows per key before the shuffle.
    """
    latest_first = Window.partitionBy(*keys).orderBy("age")
    return (
        _ages(actions.filter(F.col("type") == action_type), window, cate)
        .select(*keys, "age")
        .distinct()
        .withColumn("nth", F.row_number().over(latest_first))
        .filter(F.col("nth") == 2)
        .select(*keys, F.col("age").alias("second_dist"))
    )


def user_base(users: DataFrame, end: datetime, default_reg: datetime, cutoff: datetime) -> DataFrame:
    """Level and whole days since registration.

    A missing registration time, or one after `cutoff`, is taken as `default_reg`.
    """
    reg = F.coalesce(F.col("user_reg_tm"), ntz(default_reg))
    reg = F.when(reg > ntz(cutoff), ntz(default_reg)).otherwise(reg)
    days = F.floor(F.timestamp_diff("SECOND", reg, ntz(end)) / DAY)
    return users.select("user_id", "user_lv_cd", days.cast("long").alias("reg_days"))
