"""Log and dimensions from CSV files: monthly logs, and user, product and comment files in any charset.

Log rows that cannot be used do not stop a load: they are set apart with the reason and the file, and counted
in the pass that writes the others. A load with more of them than allowed fails, and its table is not used.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise import schema
from cartwise.sources.logs import normalise_actions, read_dimension_csv
from cartwise.sources.sinks import scratch_folder, write_actions

CORRUPT = "_corrupt"
#: Why a log row is set apart, and when. The first that holds is the reason.
REASONS = (
    ("unreadable", f"{CORRUPT} IS NOT NULL"),
    ("no key", "user_id IS NULL OR sku_id IS NULL OR time IS NULL"),
    ("unknown type", "type IS NULL OR type NOT BETWEEN 1 AND 6"),
)


def read_judged_log(spark: SparkSession, paths: list[str], encoding: str = "utf-8") -> DataFrame:
    """All rows of the log files with `file` and `reason`, which is NULL for rows that can be used."""
    raw = (
        spark.read.schema(T.StructType([*schema.RAW_ACTIONS.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # a short row is noticed whatever columns are asked for
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(paths)
    )
    whens = " ".join(f"WHEN {condition} THEN '{reason}'" for reason, condition in REASONS)
    return raw.select("*", F.input_file_name().alias("file"), F.expr(f"CASE {whens} END").alias("reason"))


@dataclass(frozen=True)
class LoadCounts:
    """Rows of a load: those used, and those set apart by reason."""

    used: int
    apart: dict[str, int]

    @property
    def share_apart(self) -> float:
        apart = sum(self.apart.values())
        return apart / max(self.used + apart, 1)


def load_log(
    spark: SparkSession,
    paths: list[str],
    table: str,
    apart: str | None = None,
    encoding: str = "utf-8",
    most_apart: float = 0.01,
) -> LoadCounts:
    """Writes the usable rows as a dated log table and, where `apart` is given, the others beside it.

    Both counts come from the pass that writes the table. More than the share `most_apart` is an error.
    """
    judged = read_judged_log(spark, paths, encoding)
    seen = Observation()
    counts = [F.count_if(F.col("reason") == reason).alias(reason) for reason, _ in REASONS]
    observed = judged.observe(seen, F.count_if(F.col("reason").isNull()).alias("used"), *counts)
    good = observed.where("reason IS NULL").drop("reason", "file", CORRUPT)
    write_actions(normalise_actions(good), table)
    if apart is not None:
        bad = judged.where("reason IS NOT NULL")
        bad.select("file", "reason", F.coalesce(CORRUPT, F.to_json(F.struct(*schema.RAW_ACTIONS.names))).alias("row")).write.mode(
            "overwrite"
        ).partitionBy("reason").parquet(apart)
    found = dict(seen.get)
    result = LoadCounts(found.pop("used"), found)
    if result.share_apart > most_apart:
        raise ValueError(f"{sum(found.values())} of the log's rows cannot be used: {found}")
    return result


@dataclass(frozen=True)
class CsvTables:
    """The library's tables from files. The log is loaded once, on first use, into `table`."""

    spark: SparkSession
    logs: list[str]
    users_file: str
    products_file: str
    comments_file: str
    encoding: str = "gbk"
    table: str | None = None
    most_apart: float = 0.01

    @cached_property
    def _log(self) -> str:
        table = self.table or scratch_folder(self.spark)
        load_log(self.spark, self.logs, table, encoding=self.encoding, most_apart=self.most_apart)
        return table

    def actions(self) -> DataFrame:
        dated = T.StructType(
            [*schema.ACTIONS.fields, T.StructField("time_zone", T.IntegerType()), T.StructField("date", T.DateType())]
        )
        return self.spark.read.schema(dated).parquet(self._log)

    def users(self) -> DataFrame:
        return read_dimension_csv(self.spark, self.users_file, schema.USERS, self.encoding)

    def products(self) -> DataFrame:
        return read_dimension_csv(self.spark, self.products_file, schema.PRODUCTS, self.encoding)

    def comments(self) -> DataFrame:
        return read_dimension_csv(self.spark, self.comments_file, schema.COMMENTS, self.encoding)


def write_csv_tables(
    actions: DataFrame, users: DataFrame, products: DataFrame, comments: DataFrame, folder: str, encoding: str = "gbk"
) -> dict[str, str | list[str]]:
    """The tables as CSV files, the log by month; returns the arguments of `CsvTables`."""

    def write(df: DataFrame, name: str, *by: str) -> str:
        writer = df.write.mode("overwrite").option("header", True).option("encoding", encoding)
        writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").partitionBy(*by).csv(f"{folder}/{name}")
        return f"{folder}/{name}"

    log = actions.select(*schema.ACTIONS.names, F.date_format("time", "yyyy-MM").alias("month"))
    months = [r["month"] for r in log.select("month").distinct().orderBy("month").collect()]
    path = write(log, "log", "month")
    return {
        "logs": [f"{path}/month={m}" for m in months],
        "users_file": write(users.select(*schema.USERS.names), "users"),
        "products_file": write(products.select(*schema.PRODUCTS.names), "products"),
        "comments_file": write(comments.select(*schema.COMMENTS.names), "comments"),
    }
