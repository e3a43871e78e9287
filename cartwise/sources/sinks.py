"""Writing tables, and cutting lineage between pipeline stages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.windows import WindowSpec, scan_window

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_FILES = 16  # tasks that share the rows of a partition


def write_actions(actions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by date, so window scans prune whole days.

    Rebalancing lets adaptive execution split a heavy day over several tasks and files. Rows are ordered
    by category inside a file, so row-group statistics also serve category filters.
    """
    (
        actions.withColumn("date", F.to_date("time"))
        .hint("rebalance", "date")
        .sortWithinPartitions("date", "cate", "time")
        .write.mode(mode)
        .partitionBy("date")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Feature tables, weights, scores and submissions, as parquet or CSV with a header."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Writes rows into a partitioned Parquet table and replaces just the partitions that they belong to, so that
    a part can be made again alone and a failed write leaves the others as they were."""
    (
        df.repartition(*by, F.pmod(F.xxhash64(*[c for c in df.columns if c not in by][:2]), F.lit(_FILES)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors reach: `spark.checkpoint.dir` of the session.

    Only a local session, whose executors are the driver, may leave it unset; it then gets a temporary
    folder. Elsewhere an unset folder is an error, since executors would write to their own disks.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get(_CHECKPOINT_CONF, None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="cartwise-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder. Its files survive lost executors, unlike cached blocks, and
    go with the frame where `spark.cleaner.referenceTracking.cleanCheckpoints` is set."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """Name of a new folder below the shared one; its owner clears it after the job."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def stage_log(actions: DataFrame) -> DataFrame:
    """The whole log as a table in the shared folder, partitioned by date, for plans that scan several windows of a
    log that is costly to derive."""
    folder = scratch_folder(actions.sparkSession)
    write_actions(actions, folder)
    schema = T.StructType([*actions.schema, T.StructField("date", T.DateType())])
    return actions.sparkSession.read.schema(schema).parquet(folder)


def stage_table(df: DataFrame, by: str) -> DataFrame:
    """The rows as a table in the shared folder, partitioned by `by`, for plans that read it many times."""
    folder = scratch_folder(df.sparkSession)
    df.write.partitionBy(by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)


def stage_actions(actions: DataFrame, window: WindowSpec, drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of the window, without the columns `drop`, as a table in the shared folder, for plans that scan
    them many times.

    The window is applied before columns go, so that it reaches the log's scan. Rows are written as they come,
    without a shuffle: a log read in time order keeps narrow time ranges per row group, so window filters still
    skip most of it.
    """
    folder = scratch_folder(actions.sparkSession)
    rows = scan_window(actions, window).drop(*drop)
    rows.write.parquet(folder)
    return actions.sparkSession.read.schema(rows.schema).parquet(folder)
