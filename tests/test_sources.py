from __future__ import annotations

from datetime import datetime

import pytest

from cartwise import schema
from cartwise.sources.logs import read_actions_csv, read_dimension_csv
from cartwise.sources.sinks import materialise, scratch_folder, shared_folder, stage_actions, write_table
from cartwise.streaming.ingest import ingest_new_files
from cartwise.windows import WindowSpec

HEADER = "user_id,sku_id,time,model_id,type,cate,brand\n"
FEBRUARY = HEADER + "266079.0,138778,2016-02-01 05:59:59,,1,8,403\n"
MARCH = HEADER + "266079.0,138778,2016-03-01 23:00:00,17,6,8,403\n"


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_monthly_logs_merge(spark, tmp_path):
    files = [write(tmp_path / "a.csv", FEBRUARY), write(tmp_path / "b.csv", MARCH)]
    rows = sorted(read_actions_csv(spark, files).collect(), key=lambda r: r.time)
    assert [(r.user_id, r.model_id, r.time_zone) for r in rows] == [(266079, None, 0), (266079, 17, 3)]
    assert rows[0].time == datetime(2016, 2, 1, 5, 59, 59)


def test_bad_log_rows_fail(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER + "1.0,x,2016-02-01 05:59:59,,1,8,403\n")
    with pytest.raises(Exception):
        read_actions_csv(spark, [path]).collect()


def test_gbk_dimension_with_further_columns(spark, tmp_path):
    text = "user_id,age,user_lv_cd,user_reg_tm\n1,26-35岁,5,2016-01-26\n2,-1,1,\n"
    path = write(tmp_path / "users.csv", text, "gbk")
    rows = read_dimension_csv(spark, path, schema.USERS).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [(1, 5, datetime(2016, 1, 26)), (2, 1, None)]


def test_table_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "user_id long, score double")
    write_table(df, str(tmp_path / "p"))
    write_table(df, str(tmp_path / "c"), "csv")
    assert spark.read.parquet(str(tmp_path / "p")).first() == df.first()
    back = spark.read.option("header", True).csv(str(tmp_path / "c")).first()
    assert tuple(back) == ("1", "2.5")


def test_streaming_ingest_takes_each_file_once(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "cp")
    source.mkdir()
    write(source / "a.csv", FEBRUARY)
    ingest_new_files(spark, str(source), table, checkpoint).awaitTermination(120)
    write(source / "b.csv", MARCH)
    ingest_new_files(spark, str(source), table, checkpoint).awaitTermination(120)
    rows = spark.read.parquet(table).collect()
    assert sorted((str(r.date), r.type, r.time_zone) for r in rows) == [
        ("2016-02-01", 1, 0),
        ("2016-03-01", 6, 3),
    ]


def test_materialise_uses_the_session_folder(spark):
    assert materialise(spark.range(3)).count() == 3
    assert scratch_folder(spark).startswith(shared_folder(spark))


def test_only_local_sessions_may_lack_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        shared_folder(Session())


def test_staged_rows_are_those_of_the_window(spark, make_log):
    log = make_log([(1, 1, "2016-03-01", 1), (1, 2, "2016-03-05", 1), (2, 2, "2016-03-10", 4)])
    staged = stage_actions(log, WindowSpec.of("2016-03-02", "2016-03-10"))
    assert [r.sku_id for r in staged.collect()] == [2] and staged.schema == log.schema


def test_short_dimension_rows_fail(spark, tmp_path):
    path = write(tmp_path / "users.csv", "user_id,user_lv_cd,user_reg_tm\n1,5,2016-01-26\n2,1\n")
    with pytest.raises(Exception):
        read_dimension_csv(spark, path, schema.USERS, "utf-8").collect()
