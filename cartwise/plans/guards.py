"""Join-cardinality guard: a left join keeps its row count when the right side's keys are unique."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Returns `df`; raises when a key repeats. Runs a job, so call it where a check is wanted."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"duplicate key {found[0].asDict()}")
    return df


@dataclass
class JoinGuard:
    """Row counts before and after the joins of one table, taken while the table is made.

    A lookup with a repeated key makes rows more, a missing one on an inner side makes them fewer. The counts
    are observed in the pass that writes the table, so the check costs no pass of its own. Tasks that were
    repeated after a lost executor may be counted twice; therefore counts that differ are looked into, with the
    written table, before they are an error.
    """

    rows_before: Observation = field(default_factory=Observation)
    rows_after: Observation = field(default_factory=Observation)

    def before(self, df: DataFrame) -> DataFrame:
        return df.observe(self.rows_before, F.count(F.lit(1)).alias("rows"))

    def after(self, df: DataFrame) -> DataFrame:
        return df.observe(self.rows_after, F.count(F.lit(1)).alias("rows"))

    def check(self, written: DataFrame, keys: list[str]) -> None:
        """To be called after the table was written."""
        before, after = self.rows_before.get["rows"], self.rows_after.get["rows"]
        if before == after:
            return
        repeated = duplicate_keys(written, keys).limit(1).collect()
        if repeated:
            raise ValueError(f"{before} rows became {after} in the joins; repeated key {repeated[0].asDict()}")
        if after < before and written.count() < before:
            raise ValueError(f"{before} rows became {after} in the joins; some keys have no match")
