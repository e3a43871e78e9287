"""The log as a table bucketed by user and partitioned by date.

Rows of a user lie in the same bucket of every day, so what is grouped or joined by user is read in place: no
exchange on `user_id`, however many plans read the table. Window scans open the days of the window only. A heavy
user is one bucket file a day; skewed readers split by day, since a bucket's days are files of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.sources.sinks import scratch_folder

BUCKETS = 64


def write_bucketed(
    actions: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Writes the log as the catalog table `table` and returns it. Files go to `path`, or to a new folder in the
    shared one. Rows are dealt by bucket first, so that each bucket of a day is one file."""
    (
        actions.withColumn("date", F.to_date("time"))
        .repartition(buckets, "user_id")
        .sortWithinPartitions("date", "user_id", "time")
        .write.mode(mode)
        .option("path", path or scratch_folder(actions.sparkSession))
        .partitionBy("date")
        .bucketBy(buckets, "user_id")
        .sortBy("user_id", "time")
        .saveAsTable(table)
    )
    return actions.sparkSession.table(table)


def append_days(actions: DataFrame, table: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds days to a bucketed log. The number of buckets must be the table's."""
    spark: SparkSession = actions.sparkSession
    held = spark.catalog.listColumns(table)
    if not any(c.name == "user_id" and c.isBucket for c in held):
        raise ValueError(f"{table} is not bucketed by user_id")
    order = [c.name for c in held if c.name != "date"]
    (
        actions.select(*order, F.to_date("time").alias("date"))
        .repartition(buckets, "user_id")
        .sortWithinPartitions("date", "user_id", "time")
        .write.mode("append")
        .partitionBy("date")
        .bucketBy(buckets, "user_id")
        .sortBy("user_id", "time")
        .saveAsTable(table)
    )
    return spark.table(table)
