from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import table

from cartwise.operators import counts, distinct, labels, recency, sequence
from cartwise.plans import pair_features as pf
from cartwise.plans import user_features as uf
from cartwise.plans.context import FeatureContext
from cartwise.plans.guards import require_unique
from cartwise.schema import COMMENTS, PRODUCTS, TIME_DECAY, USERS
from cartwise.windows import WindowSpec

END = datetime(2024, 3, 11, 6)  # not at midnight: day counts and windows disagree on purpose
W = WindowSpec(END - timedelta(days=65), END)


@pytest.fixture
def ctx(spark, make_log):
    rng = random.Random(11)
    rows = []
    for _ in range(1500):
        # User 0 owns a third of the rows.
        user = 0 if rng.random() < 0.33 else rng.randrange(1, 40)
        item = rng.randrange(20)
        back = rng.choice([rng.randrange(1, 3600), rng.randrange(1, 7 * 86400), rng.randrange(1, 64 * 86400)])
        cate = 8 if item < 8 else 4 + item % 4
        kind = rng.choice([1, 1, 1, 6, 6, 6, 2, 3, 5]) if rng.random() > 0.02 else 4
        rows.append((user, item, END - timedelta(seconds=back), kind, cate, item % 5))
    return FeatureContext(
        actions=make_log(rows),
        users=spark.createDataFrame([(u, u % 5 + 1, None) for u in range(40)], USERS),
        products=spark.createDataFrame([(i, i % 4, 1, 2) for i in range(8)], PRODUCTS),
        comments=spark.createDataFrame(
            [(datetime(2024, 3, 1).date(), i, i % 5, 0, 0.1) for i in range(8)], COMMENTS
        ),
        curve=spark.createDataFrame([(h, 1.0 / h) for h in range(1, 721)], TIME_DECAY),
        window=W,
        cate=8,
        default_reg=datetime(2024, 1, 1),
        reg_cutoff=datetime(2024, 3, 10),
    )


def test_user_table_shape_and_keys(ctx):
    df = uf.user_features(ctx)
    assert len(df.columns) == 1 + 71
    require_unique(df, ["user_id"])
    expected = {r.user_id for r in labels.candidate_users(ctx.actions, W, 8).collect()}
    assert {r.user_id for r in df.select("user_id").collect()} == expected


def test_user_columns_match_single_operators(ctx):
    got = table(uf.user_features(ctx))
    week, half = W.back(days=7), W.back(days=15)
    a = ctx.actions
    checks = [
        ("user_days", distinct.active_days(a, W, ["user_id"]), "day_cnt", 0),
        ("user_days_7d", distinct.active_days(a, week, ["user_id"]), "day_cnt", 0),
        ("cate_days_15d", distinct.active_days(a, half, ["user_id"], 8), "day_cnt", 0),
        ("user_total_full", counts.user_total_counts(a, W), "total_cnt", 0),
        ("cate_total_15d", counts.total_counts(a, half, ["user_id"], cate=8), "total_cnt", 0),
        ("user_last_dist", recency.last_distance(a, W, ["user_id"]), "last_dist", None),
        ("user_first_dist", recency.first_distance(a, W, ["user_id"]), "first_dist", None),
        ("cate_last_dist", recency.last_distance(a, W, ["user_id"], 8), "last_dist", None),
        ("max_burst", sequence.bursts(a, week), "max_burst", None),
        ("cate_dwell_7d", sequence.dwell(a, week, ["user_id"], cate=8), "dwell", None),
        ("cate_dwell_1d", sequence.dwell(a, W.back(days=1), ["user_id"], cate=8), "dwell", None),
    ]
    for column, operator, name, absent in checks:
        single = table(operator)
        for user, row in got.items():
            assert row[column] == single.get(user, {name: absent})[name], (column, user)
    rule = labels.rule_users(a, ctx.users, W, week, 8)
    ruled = {r.user_id for r in rule.collect()}
    assert {u for u, r in got.items() if r["rule_user"] == 1} == ruled & set(got)


def test_pair_table_matches_single_operators(ctx):
    df = pf.pair_features(ctx)
    assert len(df.columns) == 4 + 127
    require_unique(df, pf.PAIR)
    got = table(df, pf.PAIR)
    pairs = labels.candidate_pairs(ctx.actions, W, 8).select(*pf.PAIR).collect()
    assert set(got) == {tuple(r) for r in pairs}
    a = ctx.actions
    for h in (4, 24, 168, 672):
        single = table(counts.action_counts(a, W.back(hours=h), pf.PAIR, cate=8), pf.PAIR)
        for key, row in got.items():
            for t in (1, 2, 3, 5, 6):
                want = single[key][f"cnt_{t}"] if key in single else None
                assert row[f"pair_cnt_{t}_{h}h"] == want
    days = table(distinct.active_days(a, W, pf.PAIR), pf.PAIR)
    last = table(recency.last_distance_by_type(a, W, pf.PAIR), pf.PAIR)
    runs = table(sequence.visit_runs(a, W.back(hours=168), 8), pf.PAIR)
    for key, row in got.items():
        assert row["pair_days_full"] == days[key]["day_cnt"]
        assert row["pair_last_2"] == (last[key]["last_dist_2"] or 0)
        later = (last[key]["last_dist_2"] or 0) > (last[key]["last_dist_3"] or 0)
        assert row["pair_delcart_later"] == int(later)
        assert row["pair_runs_168h"] == runs[key]["runs"]


def test_assembled_tables(ctx):
    sku = pf.sku_features(ctx)
    require_unique(sku, pf.PAIR)
    # 127 pair, 7 brand share, 10 one-hot, 7 comment, 1 + 7 item, 2 brand, 8 sales
    assert len(sku.columns) == 4 + 127 + 7 + 10 + 7 + 8 + 2 + 8
    assert all(v is not None for r in sku.collect() for v in r)
    both = pf.training_table(ctx)
    assert len(both.columns) == len(sku.columns) + 71
    assert both.count() == sku.count() == pf.pair_features(ctx).count()


def test_blocks_survive_a_hot_user(ctx):
    """Rolled-up rows of one key are bounded by types and bands, whatever its share of the log."""
    from cartwise.operators.rollup import rollup
    from cartwise.windows import Suffixes

    s = Suffixes.days(END, (7, 15), W)
    rows = rollup(ctx.weighted(s.scan(ctx.actions)), s, ["user_id"], [])
    assert rows.filter("user_id = 0").count() <= 6 * 3
    assert rows.agg({"n": "sum"}).first()[0] == s.scan(ctx.actions).count()
