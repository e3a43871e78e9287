from __future__ import annotations

import hashlib
from datetime import date, datetime, timedelta

import pytest
from conftest import table

from cartwise.functions.joins import lookup_join
from cartwise.operators import evaluation, items, labels, ranking
from cartwise.plans.guards import duplicate_keys, require_unique
from cartwise.plans.splits import rolling_splits
from cartwise.schema import COMMENTS, PRODUCTS, USERS
from cartwise.windows import WindowSpec

END = datetime(2024, 1, 11)
W = WindowSpec(datetime(2024, 1, 1), END)


def test_board_split_is_exact_and_follows_the_digest(spark):
    pairs = [(u, i) for u in range(40) for i in range(u % 4)]
    frame = spark.createDataFrame(pairs, "user_id long, sku_id long")
    got = {(r.user_id, r.sku_id): r.board for r in labels.split_boards(frame).collect()}
    ranked = sorted(pairs, key=lambda p: hashlib.md5(f"{p[0]}:{p[1]}".encode()).hexdigest())
    expected = {p: "B" if i < len(pairs) // 2 else "A" for i, p in enumerate(ranked)}
    assert got == expected
    other = {(r.user_id, r.sku_id): r.board for r in labels.split_boards(frame, salt="x").collect()}
    assert other != got and sorted(other.values()) == sorted(got.values())


def test_known_labels_and_one_pair_per_user(spark, make_log):
    log = make_log(
        [
            (1, 3, "2024-01-12 10:00:00", 4),
            (1, 2, "2024-01-12 10:00:00", 4),
            (1, 9, "2024-01-12 10:00:00", 4),  # unlisted item
            (7, 2, "2024-01-12 10:00:00", 4),  # unlisted user
            (2, 2, "2024-01-12 10:00:00", 1),  # no purchase
        ]
    )
    products = spark.createDataFrame([(2, 1, 1, 1), (3, 1, 1, 1)], PRODUCTS)
    users = spark.createDataFrame([(1, 1, None), (2, 1, None)], USERS)
    known = labels.label_pairs_known(log, W.ahead(days=5), products, users)
    assert {tuple(r) for r in known.collect()} == {(1, 2), (1, 3)}
    assert [tuple(r) for r in labels.one_pair_per_user(known).collect()] == [(1, 2)]


def test_candidates_drop_buyers_of_the_category_only(make_log):
    log = make_log(
        [
            (1, 1, "2024-01-10 10:00:00", 1),
            (2, 1, "2024-01-10 10:00:00", 1),
            (2, 1, "2024-01-10 11:00:00", 4),
            (3, 1, "2024-01-10 10:00:00", 1),
            (3, 7, "2024-01-10 10:00:00", 4, 5),  # bought elsewhere
            (4, 1, "2024-01-03 23:59:59", 1),  # before the last week
        ]
    )
    assert {r.user_id for r in labels.candidate_users(log, W, 8).collect()} == {1, 3}
    pairs = labels.candidate_pairs(log, W, 8).select("user_id", "sku_id").collect()
    assert {tuple(r) for r in pairs} == {(1, 1), (3, 1)}


def test_rule_users_with_default_thresholds(spark, make_log):
    sub = W.back(days=7)
    carted = [(u, 1, "2024-01-08 10:00:00", 2) for u in (1, 2, 3, 4, 5)]
    log = make_log(
        carted
        + [
            (2, 1, "2024-01-02 10:00:00", 1),  # browsed before the last week too
            (3, 1, "2024-01-08 11:00:00", 4),  # bought
            (4, 1, "2024-01-09 11:00:00", 1),
            (4, 1, "2024-01-10 11:00:00", 1),  # third active day
            (6, 1, "2024-01-08 10:00:00", 1),  # never carted
        ]
    )
    users = spark.createDataFrame([(u, 2 if u == 5 else 3, None) for u in range(1, 7)], USERS)
    got = labels.rule_users(log, users, W, sub, 8).collect()
    assert [r.user_id for r in got] == [1]


def test_comment_snapshot_is_strictly_before_the_end(spark):
    rows = [
        (date(2024, 1, 1), 1, 2, 0, 0.1),
        (date(2024, 1, 8), 1, 4, 1, 0.2),
        (date(2024, 1, 11), 1, 3, 1, 0.9),
    ]
    got = table(items.comment_snapshot(spark.createDataFrame(rows, COMMENTS), END), ["sku_id"])[1]
    assert got["bad_comment_rate"] == 0.2 and got["comment_num_4"] == 1 and got["comment_num_0"] == 0


def test_unknown_attributes_share_value_zero(spark):
    products = spark.createDataFrame([(1, -1, 2, 0), (2, 3, -1, 1)], PRODUCTS)
    got = table(items.attribute_onehot(products), ["sku_id"])
    assert got[1]["a1_0"] == 1 and got[1]["a2_2"] == 1 and got[1]["a3_0"] == 1
    assert got[2]["a1_3"] == 1 and got[2]["a2_0"] == 1 and sum(got[2].values()) == 3


def test_top_items_break_ties_by_id(make_log):
    log = make_log([(u, i, "2024-01-10 10:00:00", 4) for i in range(1, 9) for u in range(2 if i == 8 else 1)])
    assert [r.sku_id for r in items.top_by_buys(log, W, 8, "sku_id", 3).collect()] == [8, 1, 2]


def test_sale_and_flow_ratios(make_log):
    log = make_log(
        [
            (1, 1, "2024-01-10 10:00:00", 4, 8, 7),
            (2, 2, "2024-01-10 10:00:00", 4, 8, 7),
            (2, 2, "2024-01-10 10:00:00", 4, 8, 7),
            (3, 1, "2024-01-02 10:00:00", 1, 8, 7),
            (3, 3, "2024-01-10 10:00:00", 1, 8, 9),
        ]
    )
    sales = table(items.sale_ratios(log, END, (1, 28)), ["sku_id"])
    assert abs(sales[1]["sale_ratio_1d"] - 1 / 3) < 1e-12 and sales[3]["sale_ratio_1d"] == 0.0
    flows = table(items.flow_ratios(log, W, (1,)), ["sku_id"])
    assert flows[1]["flow_ratio_1d"] == 0.5 and flows[2]["flow_ratio_1d"] == 1.0


PAIRS = "user_id long, sku_id long, score double"


def test_best_items_keep_ties(spark):
    scores = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5), (1, 3, 0.1), (2, 1, 0.2)], PAIRS)
    got = {(r.user_id, r.sku_id) for r in ranking.best_items(scores).collect()}
    assert got == {(1, 1), (1, 2), (2, 1)}


def test_fusion_prefers_the_pair_list_and_keeps_one_row_per_user(spark):
    scores = spark.createDataFrame(
        [(1, 1, 0.9), (1, 5, 0.9), (2, 2, 0.8), (3, 3, 0.1), (4, 4, 0.05)], PAIRS
    )
    users = spark.createDataFrame([(3, 0.9), (1, 0.8), (2, 0.1), (4, 0.05)], "user_id long, score double")
    got = {(r.user_id, r.sku_id) for r in ranking.fuse_rankings(scores, users, 2).collect()}
    assert got == {(1, 1), (3, 3)}


def truth(spark):
    rows = [(1, 1, "A"), (2, 2, "B"), (2, 9, "B"), (3, 3, "A")]
    return spark.createDataFrame(rows, "user_id long, sku_id long, board string")


def test_scores_by_hand(spark):
    pred = spark.createDataFrame([(1, 1), (2, 5), (8, 8)], "user_id long, sku_id long")
    f11 = evaluation.eval_f11(pred, truth(spark)).first()
    p, r = 2 / 3, 2 / 4
    assert abs(f11.f11 - 6 * p * r / (5 * r + p)) < 1e-12
    f12 = evaluation.eval_f12(pred, truth(spark)).first()
    p, r = 1 / 3, 1 / 4
    assert abs(f12.f12 - 5 * p * r / (2 * r + 3 * p)) < 1e-12
    total = evaluation.eval_score(pred, truth(spark)).first()
    assert abs(total.score - (0.4 * f11.f11 + 0.6 * f12.f12)) < 1e-12
    boards = table(evaluation.eval_score_by_board(pred, truth(spark)), ["board"])
    p, r = 1 / 3, 1 / 2
    assert abs(boards["A"]["f11"] - 6 * p * r / (5 * r + p)) < 1e-12
    assert boards["B"]["f12"] is None and boards["B"]["score"] is None


def test_no_hit_gives_null(spark):
    pred = spark.createDataFrame([(9, 9)], "user_id long, sku_id long")
    row = evaluation.eval_score(pred, truth(spark)).first()
    assert row.f11 is None and row.f12 is None and row.score is None


def test_cardinality_guard(spark):
    unique = spark.createDataFrame([(1,), (2,)], "user_id long")
    assert require_unique(unique, ["user_id"]) is unique
    repeated = unique.union(unique.limit(1))
    assert duplicate_keys(repeated, ["user_id"]).count() == 1
    with pytest.raises(ValueError):
        require_unique(repeated, ["user_id"])


def test_rolling_splits_defaults():
    valid, train, online = rolling_splits(datetime(2016, 4, 16))
    assert valid.features == WindowSpec.of("2016-02-01", "2016-04-06")
    assert train.features == WindowSpec.of("2016-02-06", "2016-04-11")
    assert train.label == WindowSpec.of("2016-04-11", "2016-04-16")
    assert online.features == WindowSpec.of("2016-02-11", "2016-04-16") and online.label is None
    assert online.features.end - valid.features.end == timedelta(days=10)


def test_salted_lookup_join_equals_the_plain_join(spark):
    rows = spark.range(5000).selectExpr("id AS user_id", "if(id % 3 = 0, 7, id % 50) AS sku_id")
    lookup = spark.range(40).selectExpr("id AS sku_id", "id * 10 AS price")
    plain = rows.join(lookup, "sku_id", "left")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        salted = lookup_join(rows, lookup, "sku_id", ["user_id"], salts=8)
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
