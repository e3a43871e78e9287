"""Rolling time splits: the same feature and label lengths, ending one step apart."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.labels import candidate_users, label_users
from cartwise.windows import WindowSpec

SPLIT_NAMES = ("valid", "train", "online")


@dataclass(frozen=True)
class Split:
    name: str
    features: WindowSpec
    label: WindowSpec | None


def rolling_splits(
    end: datetime,
    feature_days: float = 65,
    label_days: float = 5,
    step_days: float = 5,
    names: tuple[str, ...] = SPLIT_NAMES,
) -> list[Split]:
    """Oldest split first. The last one ends at `end` and has no label window."""
    splits = []
    for back, name in zip(range(len(names) - 1, -1, -1), names):
        cut = end - timedelta(days=back * step_days)
        features = WindowSpec(cut - timedelta(days=feature_days), cut)
        splits.append(Split(name, features, features.ahead(days=label_days) if back else None))
    return splits


def split_candidates(
    actions: DataFrame, products: DataFrame, users: DataFrame, cate: int, splits: list[Split]
) -> DataFrame:
    """Candidate users of every split with `split` and `label` (NULL where there is no label window)."""
    parts = []
    for split in splits:
        if split.label is None:
            part = candidate_users(actions, split.features, cate).withColumn(
                "label", F.lit(None).cast("int")
            )
        else:
            positives = label_users(actions, split.label, products, users)
            part = candidate_users(actions, split.features, cate, positives=positives)
        parts.append(part.select(F.lit(split.name).alias("split"), "user_id", "label"))
    return reduce(DataFrame.unionByName, parts)
