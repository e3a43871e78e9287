"""Division and fill rules as SQL text. ANSI mode raises on ``/ 0``, so every quotient uses one of these.

Arguments are column names or SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def ratio_zero_as_one(a: str, b: str) -> str:
    """``a / b`` where a zero denominator counts as one; NULL stays NULL."""
    return f"({a}) / if(({b}) = 0, 1, ({b}))"


def ratio_or_one(a: str, b: str) -> str:
    """``a / b``, 1 where the quotient is undefined."""
    return f"coalesce(try_divide({a}, {b}), 1.0D)"


def ratio_or_null(a: str, b: str) -> str:
    """``a / b``, NULL where the quotient is undefined."""
    return f"try_divide({a}, {b})"


def zero_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL -> 0 on the given (default: all numeric) columns."""
    return df.fillna(0, subset=columns)
