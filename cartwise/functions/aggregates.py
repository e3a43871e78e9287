"""Aggregates shared by the operators, as SQL text. All combine map-side and stay in codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from cartwise.windows import DAY

_BITS = 63


def _and(*conds: str | None) -> str:
    return " AND ".join(f"({c})" for c in conds if c)


def count_where(*conds: str | None) -> str:
    return f"count_if({_and(*conds)})"


def rows_of(df: DataFrame, *conds: str | None) -> str:
    """Number of matching log rows, of the log itself or of partial rows that stand for `n` each."""
    if "n" in df.columns:
        return f"sum(if({_and(*conds) or 'true'}, n, 0L))"
    return count_where(*conds) if any(conds) else "count(1)"


def is_type(*types: int) -> str:
    codes = [str(int(t)) for t in types]
    return f"type = {codes[0]}" if len(codes) == 1 else f"type IN ({', '.join(codes)})"


def first_where(column: str, *conds: str | None) -> str:
    """Smallest value over matching rows."""
    return f"min(if({_and(*conds)}, {column}, NULL))"


def sum_where(column: str, *conds: str | None) -> str:
    """Sum over matching rows, NULL when there is none."""
    return f"sum(if({_and(*conds)}, {column}, NULL))"


def weight_where(*conds: str | None) -> str:
    """Sum of recency weights over matching rows, 0 when there is none."""
    if not any(conds):
        return "coalesce(sum(weight), 0.0D)"
    return f"coalesce({sum_where('weight', *conds)}, 0.0D)"


def day_words(end: datetime, span_seconds: int) -> list[str]:
    """Day bitmap of one row as 63-bit words: the bit of its calendar day's distance to `end`.

    `span_seconds` bounds the row ages and so fixes the number of words.
    """
    back = f"datediff(DATE'{end.date().isoformat()}', to_date(time))"
    words = []
    for w in range((span_seconds // DAY + 1) // _BITS + 1):
        low = w * _BITS
        in_word = f"{back} BETWEEN {low} AND {low + _BITS - 1}"
        words.append(f"if({in_word}, shiftleft(1L, {back} - {low}), 0L)")
    return words


def active_days(end: datetime, span_seconds: int, where: str | None = None) -> str:
    """Distinct calendar days among the grouped rows, as the population of a day bitmap.

    OR-ing bitmaps replaces the second shuffle of a distinct count.
    """
    words = day_words(end, span_seconds)
    ors = [f"bit_or(if({where}, {word}, 0L))" if where else f"bit_or({word})" for word in words]
    return f"cast({' + '.join(f'bit_count({o})' for o in ors)} AS BIGINT)"
