from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cartwise.plans import models

PARAMS = models.BoostingParams(rounds=4, rate=0.3)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    rows = []
    for user in range(300):
        x, noise = rng.random(), rng.random()
        label = int(x + 0.2 * rng.random() > 0.7)
        rows.append((user, x, noise if user % 7 else None, label))
    return spark.createDataFrame(rows, "user_id long, x double, noise double, label int")


def test_train_score_save_and_load(spark, planted, tmp_path):
    model = models.train(planted, PARAMS)
    scored = models.score(model, planted)
    rows = scored.collect()
    assert len(rows) == 300 and all(0 <= r.score <= 1 for r in rows)
    labelled = scored.join(planted.select("user_id", "label"), "user_id")
    auc = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(labelled)
    assert auc > 0.9
    path = str(tmp_path / "model")
    models.save_model(model, path)
    again = models.score_saved(path, planted.drop("label")).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_cross_validated_rounds(planted):
    losses = models.cv_round_losses(planted, PARAMS, folds=2).orderBy("round").collect()
    assert [r.round for r in losses] == [1, 2, 3, 4]
    assert losses[-1].loss < losses[0].loss


def test_the_model_is_retrained_at_the_best_round(planted):
    model, rounds = models.train_best(planted, PARAMS, folds=2, patience=1)
    losses = [r.loss for r in models.cv_round_losses(planted, PARAMS, folds=2).orderBy("round").collect()]
    assert rounds == models.best_rounds(losses, 1) == model.stages[1].getNumTrees


def test_best_rounds_stops_after_patience():
    assert models.best_rounds([5, 4, 3, 3.5, 3.6, 1], patience=2) == 3
    assert models.best_rounds([5, 4, 3, 3.5, 3.6, 1], patience=9) == 6


def test_growth_stops_when_held_out_loss_is_flat(planted):
    params = replace(PARAMS, rounds=30)
    grown = models.stopped_rounds(planted, params, folds=2, tolerance=0.05).collect()
    assert len(grown) == 2 and all(1 <= r.rounds < 30 and r.loss > 0 for r in grown)
    patient = models.stopped_rounds(planted, params, folds=2, tolerance=0.0001).collect()
    assert sum(r.rounds for r in patient) > sum(r.rounds for r in grown)
    model, rounds = models.train_stopped(planted, params, folds=2, tolerance=0.05)
    assert model.stages[1].getNumTrees == rounds < 30


def test_staged_search_carries_the_best_values(planted):
    stages = (
        models.SearchStage({"depth": (1, 3)}),
        models.SearchStage({"positive_weight": (1.0, 2.0)}),
    )
    best, tried = models.staged_search(planted, replace(PARAMS, rounds=2), stages, folds=2)
    rows = tried.collect()
    assert len(rows) == 4 and all(0.5 < r.auc <= 1 for r in rows)
    assert str(best) in {r.params for r in rows if r.stage == 2}


def blocks(spark):
    """Two kinds of users, each with its own ten items, of which each user has five."""
    rng = random.Random(2)
    rows = []
    for user in range(40):
        for item in rng.sample(range(10), 5):
            rows += [(user, f"item {user % 2}-{item}", 1)] * rng.randint(1, 6)
    rows += [(99, None, 1), (0, None, 1)]
    return spark.createDataFrame(rows, "user_id long, sku_id string, type int")


def test_topics_find_planted_blocks(spark):
    mix = models.topic_features(blocks(spark), "user_id", "sku_id", 2, 30).collect()
    assert len(mix) == 40 and all(abs(r.topic_0 + r.topic_1 - 1) < 1e-6 for r in mix)
    first = {r.topic_0 > r.topic_1 for r in mix if r.user_id % 2}
    other = {r.topic_0 > r.topic_1 for r in mix if r.user_id % 2 == 0}
    assert len(first) == len(other) == 1 and first != other


def test_words_are_numbered_without_gaps(spark):
    numbered = models.word_numbers(spark.range(5000).selectExpr("concat('w', id % 777) AS w"), "w").collect()
    assert sorted(r.word for r in numbered) == list(range(777)) and len({r.w for r in numbered}) == 777


def test_bags_are_vectors_made_without_python(spark):
    log = blocks(spark)
    bags = models.bags_of_words(log, "user_id", "sku_id")
    plan = bags._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    want = {r.user_id: (r.n, r.words) for r in log.where("sku_id IS NOT NULL").groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_distinct("sku_id").alias("words")).collect()}
    got = {r.user_id: (sum(r.features.values), len(r.features.indices)) for r in bags.collect()}
    assert got == want and {r.features.size for r in bags.collect()} == {20}


def test_the_best_round_and_the_last_fit_read_one_written_table(spark, planted):
    """the feature table used to be computed for the folds and again for the last fit."""
    read = spark.sparkContext.accumulator(0)

    def counted(x):
        read.add(1)
        return x

    table = planted.withColumn("x", F.udf(counted, "double").asNondeterministic()("x"))
    models.train_best(table, PARAMS, folds=2, patience=1)
    assert read.value == 300
    models.train_stopped(table, PARAMS, folds=2, tolerance=0.05)
    assert read.value == 600


@pytest.fixture(scope="module")
def rare(spark):
    """Few positives among the rows, all of them with a large x."""
    rows = [(i, i % 50, float(i % 50), i / 7 % 1, int(i % 50 == 49 and i % 4 > 0)) for i in range(600)]
    return spark.createDataFrame(rows, "user_id long, sku_id long, x double, noise double, label int")


def test_the_pair_model_splits_where_buyers_are_rare(rare):
    """the least gain, a total, was taken for one per row, which no split reaches; all scores were the same."""
    params = replace(models.PAIR_MODEL, rounds=4)
    model = models.train(rare, params)
    assert all(tree.numNodes > 1 for tree in model.stages[1].trees)
    rows = {(r.user_id, r.sku_id): r.score for r in models.score(model, rare).collect()}
    assert min(v for k, v in rows.items() if k[1] == 49) > max(v for k, v in rows.items() if k[1] < 49)
    few = models.train(rare, replace(params, min_drop=1e6))
    assert {tree.numNodes for tree in few.stages[1].trees} == {1}


def test_the_least_drop_is_one_of_all_rows(rare):
    once, twice = (models.prepare(df, 1.2) for df in (rare, rare.unionByName(rare)))
    params = models.BoostingParams(rounds=1, min_drop=0.4, row_sample=0.5, positive_weight=1.2)
    weight = 600 + 0.2 * rare.where("label = 1").count()
    assert models.with_drop(params, once).min_gain == pytest.approx(1.6 / (0.5 * weight))
    assert models.with_drop(params, twice).min_gain == pytest.approx(0.8 / (0.5 * weight))
    assert models.with_drop(PARAMS, once) == PARAMS


@pytest.mark.parametrize("patience", [1, 3])
def test_folds_stop_growing_once_the_patience_has_passed(planted, monkeypatch, patience):
    """with thousands of rounds allowed, rounds that cannot change the best one are not grown."""
    params = replace(PARAMS, rounds=30, rate=0.8)
    losses = [r.loss for r in models.cv_round_losses(planted, params, folds=2).orderBy("round").collect()]
    grown, found = [], models.round_losses
    monkeypatch.setattr(models, "FIRST_ROUNDS", 3)

    def losses_of(rows, filled, p, parallelism):
        grown.append(p.rounds)
        return found(rows, filled, p, parallelism)

    monkeypatch.setattr(models, "round_losses", losses_of)
    _, rounds = models.train_best(planted, params, folds=2, patience=patience)
    assert rounds == models.best_rounds(losses, patience)
    assert grown == [3, 9, 27, 30][: len(grown)]
    assert all(n - models.best_rounds(losses[:n], patience) < patience for n in grown[:-1])
    assert grown[-1] == 30 or grown[-1] - rounds >= patience
