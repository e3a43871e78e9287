from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cartwise-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LOG_SCHEMA = (
    "user_id long, sku_id long, time timestamp_ntz, model_id int, type int, cate int, brand int, time_zone int"
)


@pytest.fixture
def make_log(spark):
    """Log from (user, item, time, type[, cate[, brand]]) tuples."""

    def build(rows):
        full = []
        for user, item, time, action, *rest in rows:
            t = datetime.fromisoformat(time) if isinstance(time, str) else time
            cate = rest[0] if rest else 8
            brand = rest[1] if len(rest) > 1 else item % 5
            full.append((user, item, t, None, action, cate, brand, t.hour // 6))
        return spark.createDataFrame(full, LOG_SCHEMA)

    return build


def table(df, keys=None):
    """Rows as a dictionary keyed by the key columns."""
    keys = keys or ["user_id"]
    out = {}
    for row in df.collect():
        d = row.asDict()
        key = tuple(d.pop(k) for k in keys)
        out[key[0] if len(key) == 1 else key] = d
    return out

