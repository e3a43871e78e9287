"""Adapter from a retail star schema with an event stream to the library's tables.

`events` joined with `part` gives the action log; `customer`, `part` and `lineitem` give the
dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.joins import lookup_join
from cartwise.windows import WindowSpec

# Event type -> action type, part type -> category, market segment -> user level.
EVENT_TYPES = {"view": 1, "signup": 2, "error": 3, "purchase": 4}
CATEGORIES = {"STANDARD": 4, "SMALL": 5, "MEDIUM": 6, "LARGE": 7, "ECONOMY": 8, "PROMO": 9}
LEVELS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
TARGET_TYPE = "ECONOMY"
SNAPSHOT_YEARS = (1996, 2002)


# Columns this adapter reads, declared so that opening a table starts no schema-inference job.
TABLE_SCHEMAS = {
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int",
    "customer": "c_custkey bigint, c_mktsegment string",
    "orders": "o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_partkey bigint, l_returnflag string, l_shipdate timestamp_ntz",
}


def _lookup(column: str, codes: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{value}' THEN {code}" for value, code in codes.items())
    return f"CASE {column} {whens} END"


@dataclass(frozen=True)
class RetailTables:
    """Lazy readers over one folder of parquet tables."""

    spark: SparkSession
    folder: str

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def raw_actions(self, window: WindowSpec | None = None) -> DataFrame:
        """The log without the derived quarter of the day. A window filters at the scan, as do later window
        scans by way of `ts`. Events without an item number are dropped."""
        events = self._table("events")
        if window is not None:
            events = events.filter(window.contains("ts"))
        epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        whole_second = f"{epoch} + ((ts - {epoch}) DIV INTERVAL '1' SECOND) * INTERVAL '1' SECOND"
        items = self._table("part").selectExpr(
            "p_partkey AS sku_id",
            f"{_lookup('p_type', CATEGORIES)} AS cate",
            r"cast(regexp_extract(p_brand, r'Brand#(\d+)', 1) AS INT) AS brand",
        )
        # `props` is a flat object with one number; matching it is several times faster than parsing.
        item = r"""try_cast(regexp_extract(props, r'"k"\s*:\s*(\d+)', 1) AS BIGINT)"""
        keyed = events.selectExpr("*", f"{item} AS sku_id")
        joined = lookup_join(keyed, items, "sku_id", ["user_id", "ts"], how="inner")
        return joined.selectExpr(
            "user_id",
            "sku_id",
            "ts",
            f"{whole_second} AS time",
            "if(event_type = 'click', cast(pmod(floor(value), 20) AS INT), NULL) AS model_id",
            f"""CASE WHEN event_type <> 'click' THEN {_lookup('event_type', EVENT_TYPES)}
                     WHEN pmod(sku_id, 2) = 0 THEN 6 ELSE 5 END AS type""",
            "cate",
            "brand",
            "value",
        )

    def actions(self, window: WindowSpec | None = None) -> DataFrame:
        raw = self.raw_actions(window)
        return raw.selectExpr("*", "cast(hour(time) DIV 6 AS INT) AS time_zone")

    def users(self) -> DataFrame:
        first_order = (
            self._table("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("first_order"))
        )
        return (
            self._table("customer")
            .join(first_order, "c_custkey", "left")
            .selectExpr(
                "c_custkey AS user_id",
                f"{_lookup('c_mktsegment', LEVELS)} AS user_lv_cd",
                "if(pmod(c_custkey, 10) = 0, NULL, first_order) AS user_reg_tm",
            )
        )

    def products(self) -> DataFrame:
        return self._table("part").filter(f"p_type = '{TARGET_TYPE}'").selectExpr(
            "p_partkey AS sku_id",
            "pmod(p_size, 4) - 1 AS a1",
            "pmod(p_size, 3) - 1 AS a2",
            "pmod(p_size, 3) AS a3",
        )

    def comments(self, years: tuple[int, int] = SNAPSHOT_YEARS) -> DataFrame:
        """Year-start snapshots of the years per item over everything shipped before that day.

        Lines are counted per item and year first; only those counts are moved to the item's partition, where they
        are repeated for later years without a further shuffle.
        """
        first, last = years
        yearly = (
            self._table("lineitem")
            .groupBy(F.col("l_partkey").alias("sku_id"), F.year("l_shipdate").alias("year"))
            .agg(F.expr("count(1) AS lines"), F.expr("count_if(l_returnflag = 'R') AS bad"))
        )
        snapshots = (
            yearly.filter(f"year < {last}")
            .repartition("sku_id")
            .selectExpr("*", f"explode(sequence(greatest(year + 1, {first}), {last})) AS snapshot")
            .groupBy("sku_id", F.expr("make_date(snapshot, 1, 1)").alias("dt"))
            .agg(F.sum("lines").alias("lines"), F.sum("bad").alias("bad"))
        )
        return snapshots.selectExpr(
            "dt",
            "sku_id",
            "cast(pmod(lines, 5) AS INT) AS comment_num",
            "if(bad * 3 > lines, 1, 0) AS has_bad_comment",
            "bad / lines AS bad_comment_rate",
        )
