"""Feature tables of all rolling splits as one table, partitioned by split.

The splits' windows overlap but for a few days, so everything that counts is merged from one partial table,
to which each log day is added once. A split replaces its own partition and no other, so one split can be made
again alone and a split that fails leaves the rest as it was. Splits without a label window have a NULL label.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.labels import label_pairs_known
from cartwise.plans import pair_features as pf
from cartwise.plans import user_features as uf
from cartwise.plans.context import FeatureContext
from cartwise.plans.guards import JoinGuard
from cartwise.plans.partials import with_partials
from cartwise.plans.splits import Split
from cartwise.sources.sinks import replace_partitions

#: Features of a context, labelled by the given positives.
Build = Callable[[FeatureContext, DataFrame | None], DataFrame]


def split_features(build: Build, ctx: FeatureContext, split: Split, partials_path: str | None = None) -> DataFrame:
    """The features of one split with `split` and `label`."""
    positives = None
    if split.label is not None:
        positives = label_pairs_known(ctx.actions, split.label, ctx.products, ctx.users)
    table = build(with_partials(replace(ctx, window=split.features), partials_path), positives)
    if positives is None:
        table = table.withColumn("label", F.lit(None).cast("int"))
    return table.withColumn("split", F.lit(split.name))


def write_split_table(
    build: Build, ctx: FeatureContext, splits: list[Split], path: str, partials_path: str | None = None
) -> DataFrame:
    """Makes the given splits of the table at `path`, each in its own partition, and returns the whole table.

    `partials_path` is the partial table that the splits share and add their days to.
    """
    schema = None
    for split in splits:
        table = split_features(build, ctx, split, partials_path)
        replace_partitions(table, path, ["split"])
        schema = table.schema
    read = ctx.actions.sparkSession.read
    return (read.schema(schema) if schema is not None else read).parquet(path)


def user_split_table(ctx: FeatureContext, splits: list[Split], path: str, partials_path: str | None = None) -> DataFrame:
    """User features of the candidate users of every split."""
    return write_split_table(uf.user_features, ctx, splits, path, partials_path)


def pair_split_table(ctx: FeatureContext, splits: list[Split], path: str, partials_path: str | None = None) -> DataFrame:
    """Pair, brand, item and user features of the candidate pairs of every split. Each split is checked for rows
    that its joins have repeated or lost, while it is written."""
    table = None
    for split in splits:
        guard = JoinGuard()
        table = write_split_table(pf.training_table, replace(ctx, guard=guard), [split], path, partials_path)
        guard.check(table.filter(F.col("split") == split.name), pf.PAIR)
    return table if table is not None else write_split_table(pf.training_table, ctx, [], path)
