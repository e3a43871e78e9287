"""Reading action logs and dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise import schema

def normalise_actions(raw: DataFrame) -> DataFrame:
    """Integer user ids and the quarter of the day; works on batch and streaming frames."""
    return raw.withColumn("user_id", F.col("user_id").cast("long")).withColumn(
        "time_zone", F.floor(F.hour("time") / 6).cast("int")
    )


def read_actions_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of the (monthly) log files with a header row, read in one multi-path scan."""
    raw = (
        spark.read.schema(schema.RAW_ACTIONS)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(paths)
    )
    return normalise_actions(raw)


def union_months(months: list[DataFrame]) -> DataFrame:
    """Union of monthly logs by column name, normalised."""
    merged = months[0]
    for month in months[1:]:
        merged = merged.unionByName(month)
    return normalise_actions(merged)


def read_dimension_csv(
    spark: SparkSession, path: str, table_schema: T.StructType, encoding: str = "gbk"
) -> DataFrame:
    """The declared columns of a user, product or comment file; further columns in it are dropped.

    The header decides the file's columns, so they are read as strings and cast by name. -1 style codes
    keep their value; text that does not fit the declared type and rows of another length fail the query.
    Charsets beyond Spark's own list need `spark.sql.legacy.javaCharsets`, which `build_session` sets.
    """
    raw = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("mode", "FAILFAST")
        # Rows are parsed whole, so that a short row is noticed whatever columns are asked for.
        .option("columnPruning", False)
        .csv(path)
    )
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema.fields])
