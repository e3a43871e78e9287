"""Narrow pre-aggregation for wide feature blocks.

A feature block has some sixty measures per key. Summing them straight from the log would shuffle a
sixty-column partial row for nearly every log row, because the rows of one key are spread over all input
splits. The log is therefore first counted per (key, action type, age band), where a band is the
smallest trailing window that holds the row. These rows are narrow, one key has a bounded number of
them however many actions it logged, and every trailing window is a condition on the band. Only they are
moved to the key's partition, where the wide measures need no further shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from cartwise.functions.aggregates import day_words
from cartwise.functions.exprs import Exprs, aggregate
from cartwise.windows import Suffixes


def rollup(
    rows: DataFrame, suffixes: Suffixes, keys: list[str], details: list[str], placed: bool = False
) -> DataFrame:
    """Counts, age range, day bitmap and weights per (keys, details, type, band), placed by `keys`.

    `rows` carry `age` and `whole_age`, and `weight` when recency weights are wanted. Partial rows carry `n`, how
    many log rows they stand for, and `oldest_age`, the whole age of the first. `placed` rows already lie by a part
    of the keys, as those of a bucketed log do, and are not moved.
    """
    partial = "n" in rows.columns
    spans = sorted({seconds for _, seconds in suffixes.spans})
    band = "CASE " + " ".join(f"WHEN age <= {s} THEN {s}L" for s in spans) + " END"
    measures: Exprs = {
        "n": "sum(n)" if partial else "count(1)",
        "youngest": "min(whole_age)",
        "oldest": "max(oldest_age)" if partial else "max(whole_age)",
        "nearest": "min(age)",
    }
    if "weight" in rows.columns:
        measures["w"] = "sum(weight * n)" if partial else "sum(weight)"
    for i, word in enumerate(day_words(suffixes.end, spans[-1])):
        measures[f"days_{i}"] = f"bit_or({word})"
    counted = aggregate(
        rows.selectExpr("*", f"{band} AS band"), [*keys, *details, "type", "band"], measures
    )
    return counted if placed else counted.repartition(*keys)


def _all_of(*conds: str | None) -> str:
    return " AND ".join(f"({c})" for c in conds if c) or "true"


def rows_where(*conds: str | None) -> str:
    return f"sum(if({_all_of(*conds)}, n, 0L))"


def youngest_where(*conds: str | None) -> str:
    return f"min(if({_all_of(*conds)}, youngest, NULL))"


def oldest_where(*conds: str | None) -> str:
    return f"max(if({_all_of(*conds)}, oldest, NULL))"


def weights_where(*conds: str | None) -> str:
    return f"coalesce(sum(if({_all_of(*conds)}, w, NULL)), 0.0D)"


def days_where(end: datetime, span_seconds: int, *conds: str | None) -> str:
    words = range(len(day_words(end, span_seconds)))
    counts = [f"bit_count(bit_or(if({_all_of(*conds)}, days_{i}, 0L)))" for i in words]
    return f"cast({' + '.join(counts)} AS BIGINT)"


def within(suffixes: Suffixes, label: str) -> str:
    """SQL condition on rolled-up rows: they lie in the labelled window."""
    return f"band <= {suffixes.seconds(label)}"
