"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Dimension files may come in GBK, which the CSV reader accepts only with this flag.
    "spark.sql.legacy.javaCharsets": "true",
    # The assembled tables compile more classes than the default cache of 100 keeps, so that every run
    # would compile them again.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # The pair table is wider than the default limit for whole-stage code generation.
    "spark.sql.codegen.maxFields": "300",
}


def build_session(app: str = "cartwise", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
