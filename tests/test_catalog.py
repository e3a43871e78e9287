"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from cartwise.catalog import oracle as catalog_oracle
from cartwise.catalog import queries as catalog_queries

FOLDER = os.environ.get("CARTWISE_TEST_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = catalog_queries.queries(), catalog_oracle.oracle_sql()
MODELS = {"model_submission", "model_score"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 5) if isinstance(v, (int, float)) else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


def test_registration():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
    assert set(QUERIES) - set(ORACLE) == MODELS
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    relation = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(relation.columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(relation.columns, relation.fetchall())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and len(df.columns) == 73
