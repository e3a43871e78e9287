"""Recency weights: learning the curve, and counts that use it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.aggregates import is_type, weight_where
from cartwise.functions.exprs import aggregate
from cartwise.schema import ALL_TYPES, USER_TOTAL_TYPES
from cartwise.windows import HOUR, WindowSpec, age_seconds, scan_window

CURVE_HOURS = 720

MOST_HOURS = 10 * 366 * 24


def decay_curve(
    actions: DataFrame, window: WindowSpec, buyers: DataFrame, cate: int, hours: int = CURVE_HOURS
) -> DataFrame:
    """`(time_dist, weight)` for each hour distance 1..hours.

    The raw weight at hour h is the share of buyers among the users active in `cate` during the last h
    hours; it is then min-max scaled to 0..1. Users are reduced to the hour of their latest action, so
    every hour's share is a running sum over at most `hours` rows. Hours with no user yet give NULL.
    """
    latest = (
        scan_window(actions, window, cate)
        .groupBy("user_id")
        .agg(F.min(age_seconds(window.end)).alias("age"))
        .select("user_id", F.ceil(F.col("age") / HOUR).cast("int").alias("time_dist"))
        .filter(F.col("time_dist") <= hours)
    )
    flagged = latest.join(
        buyers.select("user_id").distinct().withColumn("bought", F.lit(1)), "user_id", "left"
    )
    per_hour = flagged.groupBy("time_dist").agg(
        F.count(F.lit(1)).alias("users"), F.count("bought").alias("bought")
    )
    axis = actions.sparkSession.range(1, hours + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("time_dist")
    )
    # `axis` fixes the row count, so the un-partitioned windows see at most `hours` rows.
    upto = Window.orderBy("time_dist").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    share = axis.join(per_hour, "time_dist", "left").select(
        "time_dist", F.try_divide(F.sum("bought").over(upto), F.sum("users").over(upto)).alias("share")
    )
    low, high = F.min("share").over(everything), F.max("share").over(everything)
    return share.select("time_dist", F.try_divide(F.col("share") - low, high - low).alias("weight"))


def curve_weights(curve: DataFrame) -> list[float | None]:
    """The weights of hour distances 1, 2, ...; None where the curve has no row.

    A curve is a parameter of one row per hour (720 by default), like the coefficients of a model, so it is
    evaluated here; one that reaches beyond MOST_HOURS is an error.
    """
    rows = curve.where("time_dist >= 1").select("time_dist", "weight").limit(MOST_HOURS + 1).collect()
    known = {r["time_dist"]: r["weight"] for r in rows}
    if len(rows) > MOST_HOURS or any(hour > MOST_HOURS for hour in known):
        raise ValueError(f"a curve of more than {MOST_HOURS} hours")
    if len(known) < len(rows):
        raise ValueError("a curve with several weights for an hour")
    return [known.get(hour) for hour in range(1, max(known, default=0) + 1)]


def with_weights(rows: DataFrame, curve: DataFrame, age: str = "age") -> DataFrame:
    """Adds `weight` to rows with an age in whole seconds: that of the hour distance, whole hours plus one.

    The weights are an array literal that the hour distance indexes, so there is neither a join nor a
    shuffle. Rows beyond the curve get NULL.
    """
    weights = ", ".join("NULL" if w is None else f"{w!r}D" for w in curve_weights(curve))
    return rows.withColumn("weight", F.expr(f"get(cast(array({weights}) AS array<double>), cast({age} DIV {HOUR} AS INT))"))


def decayed_counts(
    actions: DataFrame,
    window: WindowSpec,
    curve: DataFrame,
    keys: list[str],
    types=ALL_TYPES,
    cate: int | None = None,
) -> DataFrame:
    """`decay_<type>`: sum of weights per key and type."""
    rows = scan_window(actions, window, cate).withColumn("age", age_seconds(window.end))
    exprs = {f"decay_{t}": weight_where(is_type(t)) for t in types}
    return aggregate(with_weights(rows, curve), keys, exprs)


def decayed_totals(
    actions: DataFrame,
    window: WindowSpec,
    curve: DataFrame,
    keys: list[str],
    types=None,
    cate: int | None = None,
) -> DataFrame:
    """`total_decay`: sum of weights per key over `types` (all when None)."""
    rows = scan_window(actions, window, cate).withColumn("age", age_seconds(window.end))
    total = weight_where(None if types is None else is_type(*types))
    return aggregate(with_weights(rows, curve), keys, {"total_decay": total})


def user_decayed_totals(
    actions: DataFrame, window: WindowSpec, curve: DataFrame, types=USER_TOTAL_TYPES
) -> DataFrame:
    return decayed_totals(actions, window, curve, ["user_id"], types)


def fit_curve(curve: DataFrame) -> DataFrame:
    """Evaluates a lazy curve once and returns it as a local table, so that plans that use it several times do
    not learn it again."""
    cells = ", ".join(
        f"({hour}, {'NULL' if w is None else f'{w!r}D'})" for hour, w in enumerate(curve_weights(curve), 1)
    )
    empty = "" if cells else " LIMIT 0"
    return curve.sparkSession.sql(
        "SELECT cast(time_dist AS INT) AS time_dist, cast(weight AS DOUBLE) AS weight "
        f"FROM VALUES {cells or '(0, 0.0D)'} AS c(time_dist, weight){empty}"
    )
