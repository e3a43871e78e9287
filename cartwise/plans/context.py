"""What a feature plan needs: the log, the dimensions, the window and the target category."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from cartwise.operators.decay import with_weights
from cartwise.operators.sequence import MAX_GAP
from cartwise.plans.guards import JoinGuard
from cartwise.windows import WindowSpec


@dataclass(frozen=True)
class FeatureContext:
    """Inputs of the assembled feature tables. Frames are lazy; nothing is read here.

    An item belongs to one category and one brand; the assembled tables rely on it. Running
    `require_unique(item_category_brand(actions, window), ["sku_id"])` checks a log for it.
    """

    actions: DataFrame
    users: DataFrame
    products: DataFrame
    comments: DataFrame
    # None leaves the decayed columns out of the blocks.
    curve: DataFrame | None
    window: WindowSpec
    cate: int
    default_reg: datetime
    reg_cutoff: datetime
    max_gap: int = MAX_GAP
    candidate_days: int = 7
    # First day of the log: brand membership of items is taken from there, not from the window start.
    log_start: datetime | None = None
    # Written parts of the log, see `partials.with_partials`: hourly counts, and the candidates' recent rows.
    partials: DataFrame | None = None
    candidate_actions: DataFrame | None = None
    # Whether the log lies by user, see `sources.bucketed`: then user and pair blocks do not move it.
    by_user: bool = False
    # Counts the rows of the assembled tables around their joins, see `guards.JoinGuard`.
    guard: JoinGuard | None = None

    @property
    def placed(self) -> bool:
        return self.by_user and self.partials is None

    def weighted(self, rows: DataFrame) -> DataFrame:
        return rows if self.curve is None else with_weights(rows, self.curve, "whole_age")

    @property
    def counted(self) -> DataFrame:
        """Rows to count: partial rows where there are some, else those of the log."""
        return self.actions if self.partials is None else self.partials

    @property
    def end(self) -> datetime:
        return self.window.end
