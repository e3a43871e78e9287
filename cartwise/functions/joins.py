"""Lookup joins that hold up when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "left",
    salts: int | None = None,
) -> DataFrame:
    """Joins `rows` with a lookup of unique keys.

    A plain join, which adaptive execution turns into a broadcast or splits where it is skewed. With `salts`
    the lookup is repeated once per salt and joined on (key, salt), so that the rows of one key spread over
    that many tasks; `spread_by` are the columns the salt is hashed from. Every row meets its key either way.
    """
    if salts is None:
        return rows.join(lookup, key, how)
    salted_rows = rows.withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(repeated, [key, _SALT], how).drop(_SALT)
