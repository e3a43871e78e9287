"""Named SQL expressions: feature tables are dictionaries of ``column name -> SQL text``.

Wide tables have hundreds of columns; as text each costs one call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Exprs = dict[str, str]


def project(df: DataFrame, keys: list[str], exprs: Exprs) -> DataFrame:
    return df.selectExpr(*keys, *[f"{sql} AS `{name}`" for name, sql in exprs.items()])


def aggregate(df: DataFrame, keys: list[str], exprs: Exprs) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} AS `{name}`") for name, sql in exprs.items()])
