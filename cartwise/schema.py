"""Declared schemas of the input tables and the action-type codes."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import types as T


class ActionType(IntEnum):
    """Codes of the `type` column (fixed values)."""

    BROWSE = 1
    CART = 2
    DELCART = 3
    BUY = 4
    FAVOUR = 5
    CLICK = 6


ALL_TYPES = tuple(int(t) for t in ActionType)
# User totals count passive actions only; user-category, user-item and user-brand totals count all.
USER_TOTAL_TYPES = (int(ActionType.BROWSE), int(ActionType.CLICK))
NON_BUY_TYPES = tuple(t for t in ALL_TYPES if t != ActionType.BUY)
TIME_ZONES = (0, 1, 2, 3)

ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("sku_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("model_id", T.IntegerType()),
        T.StructField("type", T.IntegerType()),
        T.StructField("cate", T.IntegerType()),
        T.StructField("brand", T.IntegerType()),
    ]
)

# Monthly logs carry the user id as a decimal string such as "266079.0"; it is cast on ingest.
RAW_ACTIONS = T.StructType(
    [T.StructField("user_id", T.DoubleType())] + [f for f in ACTIONS.fields if f.name != "user_id"]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("user_lv_cd", T.IntegerType()),
        T.StructField("user_reg_tm", T.TimestampNTZType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("sku_id", T.LongType()),
        T.StructField("a1", T.IntegerType()),
        T.StructField("a2", T.IntegerType()),
        T.StructField("a3", T.IntegerType()),
    ]
)

COMMENTS = T.StructType(
    [
        T.StructField("dt", T.DateType()),
        T.StructField("sku_id", T.LongType()),
        T.StructField("comment_num", T.IntegerType()),
        T.StructField("has_bad_comment", T.IntegerType()),
        T.StructField("bad_comment_rate", T.DoubleType()),
    ]
)

TIME_DECAY = T.StructType(
    [T.StructField("time_dist", T.IntegerType()), T.StructField("weight", T.DoubleType())]
)
