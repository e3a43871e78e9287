"""Picking items and users from scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_items(pair_scores: DataFrame) -> DataFrame:
    """The items with the user's highest score, ties kept.

    The maximum combines map-side and is joined back on (user, score), so a user with very many pairs
    is never sorted in one task.
    """
    best = pair_scores.groupBy("user_id").agg(F.max("score").alias("score"))
    return pair_scores.join(best, ["user_id", "score"], "left_semi").select("user_id", "sku_id", "score")


def fuse_rankings(pair_scores: DataFrame, user_scores: DataFrame, top_n: int = 500) -> DataFrame:
    """One item per user from the top pairs and from the best items of the top users.

    Pairs outrank users; a user's tied items resolve to the lowest item id.
    """
    best = best_items(pair_scores)
    top_pairs = best.orderBy(F.desc("score"), "user_id", "sku_id").limit(top_n)
    top_users = user_scores.orderBy(F.desc("score"), "user_id").limit(top_n).select("user_id")
    of_users = best.join(top_users, "user_id", "left_semi")
    both = top_pairs.select("user_id", "sku_id", F.lit(0).alias("source")).unionByName(
        of_users.select("user_id", "sku_id", F.lit(1).alias("source"))
    )
    return (
        both.groupBy("user_id")
        .agg(F.min(F.struct("source", "sku_id")).alias("pick"))
        .select("user_id", F.col("pick.sku_id").alias("sku_id"))
    )
