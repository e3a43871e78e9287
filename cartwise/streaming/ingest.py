"""Incremental form of the monthly log merge: new CSV files are appended to the dated log table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwise import schema
from cartwise.sources.logs import normalise_actions


def ingest_new_files(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Appends the files that appeared in `folder` since the last run, then stops.

    The checkpoint records which files were taken, so a rerun after a failure neither skips nor repeats
    any of them.
    """
    raw = (
        spark.readStream.schema(schema.RAW_ACTIONS)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(folder)
    )
    return (
        normalise_actions(raw)
        .withColumn("date", F.to_date("time"))
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
