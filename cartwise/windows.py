"""Half-open time windows and families of trailing windows that share one end.

Every feature window is a suffix ``[T - d, T)``. A family of suffixes is served by one scan of the
longest one: rows carry their age in seconds, rounded up, and each window is a comparison on that age.
Order-dependent operators take the rows of one such second as one moment.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR = 3600
DAY = 24 * HOUR


def as_datetime(value: str | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def _literal(value: datetime) -> str:
    return f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'"


def ntz(value: datetime) -> Column:
    """Timestamp-without-zone literal, so that filters on `time` reach the scan."""
    return F.expr(_literal(value))


@dataclass(frozen=True)
class WindowSpec:
    """``[start, end)`` on the `time` column."""

    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: str | datetime, end: str | datetime) -> WindowSpec:
        return cls(as_datetime(start), as_datetime(end))

    def back(self, *, days: float = 0, hours: float = 0) -> WindowSpec:
        """Trailing window of the given length that ends where this one ends."""
        return WindowSpec(self.end - timedelta(days=days, hours=hours), self.end)

    def ahead(self, *, days: float) -> WindowSpec:
        """Window of the given length that starts where this one ends."""
        return WindowSpec(self.end, self.end + timedelta(days=days))

    def shift(self, *, days: float) -> WindowSpec:
        delta = timedelta(days=days)
        return WindowSpec(self.start + delta, self.end + delta)

    @property
    def seconds(self) -> int:
        return int((self.end - self.start).total_seconds())

    def where(self, column: str = "time") -> str:
        """SQL condition: the column lies in the window."""
        return f"{column} >= {_literal(self.start)} AND {column} < {_literal(self.end)}"

    def contains(self, column: str = "time") -> Column:
        return F.expr(self.where(column))


def age_seconds(end: datetime, column: str = "time") -> Column:
    """Whole seconds from `column` to `end`."""
    return F.expr(f"({_literal(end)} - {column}) DIV INTERVAL '1' SECOND")


def age_seconds_up(end: datetime, column: str = "time") -> Column:
    """Seconds from `column` to `end`, rounded up: at most `s` just where the row is no older than `s`."""
    return F.expr(f"({_literal(end)} - {column} + INTERVAL '0.999999' SECOND) DIV INTERVAL '1' SECOND")


@dataclass(frozen=True)
class Suffixes:
    """Trailing windows of one end time, addressed by label and held as lengths in seconds."""

    end: datetime
    spans: tuple[tuple[str, int], ...]

    @classmethod
    def days(cls, end: datetime, days, full: WindowSpec | None = None) -> Suffixes:
        spans = [(f"{d}d", int(d * DAY)) for d in days]
        if full is not None:
            spans.append(("full", full.seconds))
        return cls(end, tuple(spans))

    @classmethod
    def hours(cls, end: datetime, hours) -> Suffixes:
        return cls(end, tuple((f"{h}h", int(h * HOUR)) for h in hours))

    @property
    def labels(self) -> list[str]:
        return [label for label, _ in self.spans]

    def seconds(self, label: str) -> int:
        return dict(self.spans)[label]

    @property
    def longest(self) -> WindowSpec:
        return WindowSpec(self.end - timedelta(seconds=max(s for _, s in self.spans)), self.end)

    def within(self, label: str) -> str:
        """SQL condition on the `age` column: the row lies in the labelled window."""
        return f"age <= {self.seconds(label)}"

    def scan(self, actions: DataFrame, cate: int | None = None) -> DataFrame:
        """Rows of the longest window with their age, rounded up for windows and as whole seconds. Partial rows
        have the ages of their last action, and the whole age of their first."""
        rows = scan_window(actions, self.longest, cate)
        ages = {"age": age_seconds_up(self.end), "whole_age": age_seconds(self.end)}
        if "first" in actions.columns:
            ages["oldest_age"] = age_seconds(self.end, "first")
        return rows.withColumns(ages)


def scan_window(
    actions: DataFrame, window: WindowSpec, cate: int | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Rows with ``start <= time < end``, optionally of one category and projected to `columns`.

    A log partitioned by `date` is also filtered on that column, so whole days are never opened. A log whose
    `time` is the raw `ts` cut to whole seconds is also filtered on `ts`, which reaches the file scan.
    """
    rows = actions.filter(window.contains())
    if "ts" in actions.columns:
        cut = timedelta(seconds=1) if window.end.microsecond else timedelta()
        rows = rows.filter(WindowSpec(window.start, window.end + cut).contains("ts"))
    if "date" in actions.columns:
        last = window.end - timedelta(microseconds=1)
        rows = rows.filter(F.col("date").between(F.lit(window.start.date()), F.lit(last.date())))
    if cate is not None:
        rows = rows.filter(F.col("cate") == cate)
    return rows if columns is None else rows.select(*columns)
