from __future__ import annotations

import re
import uuid
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from test_feature_tables import END, ctx  # noqa: F401
from test_split_tables import rows

from cartwise.plans import pair_features as pf
from cartwise.plans import user_features as uf
from cartwise.plans.guards import JoinGuard
from cartwise.plans.split_tables import pair_split_table
from cartwise.plans.splits import Split
from cartwise.sources.bucketed import append_days, write_bucketed
from cartwise.sources.csv_tables import CsvTables, load_log, read_judged_log, write_csv_tables

HEADER = "user_id,sku_id,time,model_id,type,cate,brand\n"
GOOD = "1.0,5,2016-02-01 05:59:59,,1,8,3\n"
BAD = (
    "x,5,2016-02-01 05:59:59,,1,8,3\n"  # no number
    "1.0,5\n"  # short
    "1.0,,2016-02-01 05:59:59,,1,8,3\n"  # no item
    "1.0,5,2016-02-01 05:59:59,,7,8,3\n"  # no such type
)


def test_unusable_rows_are_set_apart_and_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + GOOD * 3)
    (tmp_path / "b.csv").write_text(HEADER + GOOD + BAD)
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    counts = load_log(spark, paths, str(tmp_path / "log"), str(tmp_path / "apart"), most_apart=0.5)
    assert counts.used == 4 and counts.apart == {"unreadable": 2, "no key": 1, "unknown type": 1}
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    apart = spark.read.parquet(str(tmp_path / "apart")).collect()
    assert sorted(r.reason for r in apart) == ["no key", "unknown type", "unreadable", "unreadable"]
    assert all(r.file.endswith("b.csv") for r in apart) and any(r.row.startswith("x,5") for r in apart)
    with pytest.raises(ValueError):
        load_log(spark, paths, str(tmp_path / "again"), most_apart=0.1)
    assert read_judged_log(spark, paths[:1]).where("reason IS NULL").count() == 3


def test_tables_from_gbk_files_give_the_same_training_table(ctx, tmp_path):  # noqa: F811
    spark = ctx.actions.sparkSession
    files = write_csv_tables(ctx.actions, ctx.users, ctx.products, ctx.comments, str(tmp_path))
    assert len(files["logs"]) == 3
    tables = CsvTables(spark, **files)
    read = replace(
        ctx, actions=tables.actions(), users=tables.users(), products=tables.products(), comments=tables.comments()
    )
    assert rows(pf.training_table(read)) == rows(pf.training_table(ctx))


def under_exchanges(plan):
    """The parts of the plan below each exchange by user."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[ :+*()0-9-]*", line).group()) for line in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(user_id" in line:
            end = next((j for j in range(i + 1, len(lines)) if line.find("Exchange") >= depth[j]), len(lines))
            yield "\n".join(lines[i + 1 : end])


@pytest.fixture
def bucketed(ctx, tmp_path):  # noqa: F811
    name = f"log_{uuid.uuid4().hex}"
    yield write_bucketed(ctx.actions, name, 8, str(tmp_path / "log")), name
    ctx.actions.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def test_user_features_read_buckets_without_an_exchange(ctx, bucketed):  # noqa: F811
    spark, (log, _) = ctx.actions.sparkSession, bucketed
    mine = replace(ctx, actions=log, by_user=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is run
    try:
        features = uf.user_features(mine)
        plan = features._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange hashpartitioning(user_id" in plan  # the users, who are dealt to the log's buckets
    assert not any("FileScan" in below for below in under_exchanges(plan))
    assert "Bucketed: true" in plan and "PartitionFilters: [isnotnull(date" in plan
    assert log.columns == [*ctx.actions.columns, "date"]
    assert rows(uf.user_features(mine)) == rows(uf.user_features(ctx))


def test_days_are_appended_to_their_buckets(ctx, bucketed, make_log):  # noqa: F811
    log, name = bucketed
    more = make_log([(1, 1, END + timedelta(days=1), 1), (2, 1, END + timedelta(days=2), 1)])
    after = append_days(more, name, 8)
    assert after.count() == ctx.actions.count() + 2
    assert after.filter(f"date = DATE'{(END + timedelta(days=1)).date()}'").count() == 1
    log.sparkSession.range(1).write.saveAsTable(plain := f"plain_{uuid.uuid4().hex}")
    with pytest.raises(ValueError):
        append_days(more, plain, 8)
    log.sparkSession.sql(f"DROP TABLE {plain}")


def test_a_repeated_item_is_noticed_while_the_table_is_written(ctx, tmp_path):  # noqa: F811
    split = Split("online", ctx.window, None)
    table = pair_split_table(ctx, [split], str(tmp_path / "good"))
    assert table.count() > 0
    seen = [r.sku_id for r in table.select("sku_id").distinct().collect()]
    twice = ctx.products.union(ctx.products.filter(f"sku_id = {seen[0]}"))
    with pytest.raises(ValueError, match="repeated key"):
        pair_split_table(replace(ctx, products=twice), [split], str(tmp_path / "bad"))


def test_counts_that_differ_are_looked_into(spark):
    guard, rows_ = JoinGuard(), spark.range(4)
    guard.after(guard.before(rows_).filter("id > 0")).collect()
    guard.check(rows_, ["id"])  # counted wrongly, but the table is whole
    with pytest.raises(ValueError, match="no match"):
        guard.check(rows_.filter("id > 0"), ["id"])


def test_dates_of_comments_survive_csv(ctx, tmp_path):  # noqa: F811
    files = write_csv_tables(ctx.actions, ctx.users, ctx.products, ctx.comments, str(tmp_path), "utf-8")
    tables = CsvTables(ctx.actions.sparkSession, encoding="utf-8", **files)
    assert {r.dt for r in tables.comments().collect()} == {date(2024, 3, 1)}
    late = ctx.actions.agg({"time": "max"}).first()[0]
    assert tables.actions().agg({"time": "max"}).first()[0] == late < datetime(2024, 3, 12)
