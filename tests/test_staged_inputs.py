"""Model queries derive the log and the comments once and read what was written."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest

from cartwise.catalog import queries as catalog
from cartwise.sources.retail import RetailTables

KINDS = ("view", "signup", "error", "purchase", "click")
TABLES = {
    "events": "ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "part": "p_partkey long, p_brand string, p_type string, p_size int",
    "customer": "c_custkey long, c_mktsegment string",
    "orders": "o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_partkey long, l_returnflag string, l_shipdate timestamp_ntz",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with null keys and times, repeated rows, unlisted items and items without comments."""
    out = str(tmp_path_factory.mktemp("retail"))
    events = [(None, 1, "view", 1.0, '{"k": 1}'), (datetime(2024, 1, 20), None, "click", None, '{"k": 2}')]
    for user in range(40):
        for i in range(12):
            at = datetime(2024, 1, 12 + (user + i) % 18, 6 * (i % 4), user, 0, 250_000)
            kind = KINDS[(user * 7 + i) % 5]
            item = (user * 3 + i) % 11  # item 10 is not listed
            events += [(at, user, kind, float(i), f'{{"k": {item}}}')] * (1 + (i == 5))
    rows = {
        "events": events,
        "part": [(i, f"Brand#{i % 3}", "ECONOMY" if i < 7 else "PROMO", 5 + i) for i in range(10)],
        "customer": [(u, ("AUTOMOBILE", "MACHINERY")[u % 2]) for u in range(35)],
        "orders": [(u, datetime(1995 + u % 4, 1, 1)) for u in range(35)],
        "lineitem": [
            *[(i % 9, "RAN"[(i // 9) % 3], datetime(1993 + i % 8, 5, 1)) for i in range(150)],
            (None, "R", datetime(1997, 1, 1)),
            (3, None, datetime(1997, 1, 1)),
            (3, "R", None),
        ],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{out}/{name}.parquet")
    return out


def sources(df):
    """Which of the large tables the rest of a plan still scans."""
    return {name for name in ("events", "lineitem") for file in df.inputFiles() if f"/{name}.parquet/" in file}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_staged_inputs_are_the_same_rows_read_once(spark, folder):
    plain, staged = catalog.Inputs(spark, folder), catalog.StagedInputs(spark, folder)
    assert sources(plain.actions) == {"events"} and sources(plain.comments) == {"lineitem"}
    assert not sources(staged.actions) and not sources(staged.comments)
    kept = plain.actions.drop("ts", "value", "model_id")
    assert kept.count() > 400
    assert rows_of(staged.actions.select(*kept.columns)) == rows_of(kept)
    assert staged.comments.dtypes == plain.comments.dtypes
    assert rows_of(staged.comments) == rows_of(plain.comments)
    assert staged.context(catalog.W, decayed=True) is staged.context(catalog.W, decayed=True)
    assert rows_of(staged.fitted_curve()) == rows_of(plain.fitted_curve())


@pytest.mark.parametrize("name", ["_user_table", "_pair_table"])
def test_feature_tables_of_staged_inputs_are_the_same(spark, folder, name):
    build = getattr(catalog, name)
    staged = catalog.StagedInputs(spark, folder)
    for window, labelled in ((catalog._train_split(), True), (catalog.W, False)):
        before = catalog.comparable(build(catalog.Inputs(spark, folder), window, labelled))
        after = catalog.comparable(build(staged, window, labelled))
        assert not sources(after)
        assert before.count() > 5
        assert rows_of(after.select(*before.columns)) == rows_of(before)


@pytest.mark.parametrize("name", ["train_sku_model", "score_pairs"])
def test_scored_tables_do_not_go_back_to_the_log(spark, folder, name):
    """scoring used to derive the log, and in training the whole table, once more."""
    assert not sources(catalog.queries()[name](spark, folder))


def test_comment_counts_move_once_to_their_item(spark, folder):
    """rows were repeated for later years before a second shuffle."""
    comments = RetailTables(spark, folder).comments()
    plan = comments._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")
    found = {(r.sku_id, r.dt.year): (r.comment_num, r.has_bad_comment) for r in comments.collect()}
    lines = [r for r in spark.read.parquet(f"{folder}/lineitem.parquet").collect() if r.l_shipdate]
    for item in {r.l_partkey for r in lines}:
        for year in range(1996, 2003):
            mine = [r for r in lines if r.l_partkey == item and r.l_shipdate.year < year]
            bad = sum(r.l_returnflag == "R" for r in mine)
            expected = (len(mine) % 5, int(bad * 3 > len(mine))) if mine else None
            assert found.get((item, year)) == expected


def test_trained_models_have_all_rounds(spark, folder, monkeypatch):
    """the registered models were trained for five rounds of 0.01; train_sku_model grows the tuned number."""
    seen, train = [], catalog.models.train
    monkeypatch.setattr(catalog.models, "train", lambda t, p: seen.append(p) or train(t, replace(p, rounds=2)))
    for name in ("train_sku_model", "score_users"):
        catalog.queries()[name](spark, folder)
    assert [p.rounds for p in seen] == [1378, 1200]
    assert seen == [catalog.models.PAIR_MODEL, catalog.models.USER_MODEL]


def test_submitted_models_search_all_rounds(spark, folder, monkeypatch):
    """the best round of the submission's models was searched among five, with a patience of two."""
    seen, best = [], catalog.models.train_best

    def searched(table, params, folds, patience):
        seen.append(("sku_id" in table.columns, params.rounds, folds, patience))
        return best(table, replace(params, rounds=3), folds, patience)

    monkeypatch.setattr(catalog.models, "train_best", searched)
    assert catalog._model_submission(catalog.StagedInputs(spark, folder)).count() > 0
    assert seen == [(True, 5000, 5, 50), (False, 3000, 5, 20)]
