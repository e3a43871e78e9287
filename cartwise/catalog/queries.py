"""One registered query per operator, on the retail tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.catalog import setting as cfg
from cartwise.operators import counts, decay, distinct, evaluation, items, labels, ranking, recency, sequence, sketches
from cartwise.plans import models, split_tables, splits
from cartwise.plans import pair_features as pf
from cartwise.plans import user_features as uf
from cartwise.plans.context import FeatureContext
from cartwise.sources.bucketed import write_bucketed
from cartwise.sources.csv_tables import CsvTables, write_csv_tables
from cartwise.sources.logs import union_months
from cartwise.sources.retail import RetailTables
from cartwise.sources.sinks import materialise, scratch_folder, stage_log, stage_table
from cartwise.windows import Suffixes, WindowSpec, scan_window

Query = Callable[[SparkSession, str], DataFrame]

U, I, C, B = "user_id", "sku_id", "cate", "brand"
CART = 2


def comparable(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, doubles rounded to six places, timestamps as text."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(field.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(*columns)


class Inputs:
    """Lazy tables and derived inputs of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.tables = RetailTables(spark, folder)

    @cached_property
    def actions(self) -> DataFrame:
        return self.tables.actions()

    @cached_property
    def users(self) -> DataFrame:
        return self.tables.users()

    @cached_property
    def products(self) -> DataFrame:
        return self.tables.products()

    @cached_property
    def comments(self) -> DataFrame:
        return self.tables.comments()

    def curve(self) -> DataFrame:
        buyers = labels.label_users(self.actions, cfg.CURVE_LABEL, self.products, self.users)
        return decay.decay_curve(self.actions, cfg.CURVE_WINDOW, buyers, cfg.CATE)

    def fitted_curve(self) -> DataFrame:
        return decay.fit_curve(self.curve())

    def context(self, window: WindowSpec = cfg.WINDOW, decayed: bool = False) -> FeatureContext:
        return FeatureContext(
            actions=self.actions,
            users=self.users,
            products=self.products,
            comments=self.comments,
            curve=self.fitted_curve() if decayed else None,
            window=window,
            cate=cfg.CATE,
            default_reg=cfg.DEFAULT_REG,
            reg_cutoff=cfg.REG_CUTOFF,
            max_gap=cfg.MAX_GAP,
        )

    def positives(self) -> DataFrame:
        return labels.eval_split_known(self.actions, cfg.LABEL, self.products, self.users)

    def pair_positives(self) -> DataFrame:
        return labels.label_pairs_known(self.actions, cfg.LABEL, self.products, self.users)

    def scores(self, keys: list[str]) -> DataFrame:
        """Stand-in score: mean event value over the last week of the target category, in exact cents."""
        cents = F.sum(F.round(F.col("value") * 100).cast("long"))
        recent = scan_window(self.actions, cfg.SUB, cfg.CATE)
        return recent.groupBy(*keys).agg(F.round(cents / F.count(F.lit(1)), 6).alias("score"))

    def submission(self) -> DataFrame:
        return ranking.fuse_rankings(self.scores([U, I]), self.scores([U]), cfg.TOP_RANKED)


class StagedInputs(Inputs):
    """Inputs of the model queries, which build several feature tables: the log and the comments are derived and
    written once, the curve is fitted once, and a window's candidate rows are staged once for all its tables."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self._contexts: dict[tuple[WindowSpec, bool], FeatureContext] = {}

    @cached_property
    def actions(self) -> DataFrame:
        return stage_log(self.tables.actions().drop(*uf.UNREAD))

    @cached_property
    def comments(self) -> DataFrame:
        return stage_table(self.tables.comments(), "dt")

    @cached_property
    def _curve(self) -> DataFrame:
        return super().fitted_curve()

    def fitted_curve(self) -> DataFrame:
        return self._curve

    def context(self, window: WindowSpec = cfg.WINDOW, decayed: bool = False) -> FeatureContext:
        if (window, decayed) not in self._contexts:
            self._contexts[window, decayed] = uf.stage_candidates(super().context(window, decayed))
        return self._contexts[window, decayed]


def _months(x: Inputs) -> DataFrame:
    """The log cut into three parts, the first and the last without an outer bound, and merged again."""
    raw = x.tables.raw_actions().drop("value", "ts")
    first, second = (F.expr(f"TIMESTAMP_NTZ'{day} 00:00:00'") for day in ("2024-01-11", "2024-01-21"))
    time = F.col("time")
    parts = [time < first, (time >= first) & (time < second), (time >= second) | time.isNull()]
    return union_months([raw.filter(part) for part in parts])


def _split_windows() -> list[splits.Split]:
    """The splits, each with features over as many days as the window has."""
    return splits.rolling_splits(W.end, (W.end - W.start).days, cfg.SPLIT_LABEL_DAYS, cfg.SPLIT_STEP_DAYS)


def _split_table(x: Inputs, write: Callable[..., DataFrame]) -> DataFrame:
    """All three splits, written one after the other into one table over shared partial rows."""
    folder, partials = (scratch_folder(x.tables.spark) for _ in range(2))
    return write(x.context(decayed=True), _split_windows(), folder, partials)


def _bucketed_users(x: Inputs) -> DataFrame:
    """User features from the log as a table bucketed by user."""
    log = write_bucketed(x.actions.drop("ts", "value"), f"actions_{uuid.uuid4().hex}", cfg.BUCKETS)
    return uf.user_features(replace(x.context(decayed=True), actions=log, by_user=True), x.positives())


def _users_from_csv(x: Inputs) -> DataFrame:
    """User features from CSV files of the log and the dimensions."""
    folder = scratch_folder(x.tables.spark)
    files = write_csv_tables(x.actions, x.users, x.products, x.comments, folder, encoding="utf-8")
    tables = CsvTables(x.tables.spark, encoding="utf-8", **files)
    ctx = x.context(decayed=True)
    read = replace(
        ctx, actions=tables.actions(), users=tables.users(), products=tables.products(), comments=tables.comments()
    )
    positives = labels.eval_split_known(read.actions, cfg.LABEL, read.products, read.users)
    return uf.user_features(read, positives)


def _sketched_flow(x: Inputs) -> DataFrame:
    """Items with whether the users estimated from daily sketches are near the exact ones, over two windows."""
    log = x.actions
    made = materialise(sketches.daily_sketches(log, W, [I], U))
    out = None
    for label, window in (("all", W), ("week", S)):
        exact = distinct.distinct_count(log, window, [I], U, "exact")
        near = F.abs(F.col("users") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * cfg.SKETCH_ERROR)
        rows = sketches.sketched_distinct(made, window, [I], "users").join(exact, I, "full")
        rows = rows.select(I, F.lit(label).alias("span"), near.alias("near"), "exact")
        out = rows if out is None else out.unionByName(rows)
    return out


def _keyed_pairs(x: Inputs) -> DataFrame:
    return labels.candidate_pairs(x.actions, cfg.WINDOW, cfg.CATE)


W, S, CATE = cfg.WINDOW, cfg.SUB, cfg.CATE


def _operators() -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        # sources and scans
        "ingest_actions": _months,
        "window_scan": lambda x: scan_window(x.actions, W, columns=[U, I, "time", "type", C, B]),
        # counts
        "user_action_cnt": lambda x: counts.action_counts(x.actions, W, [U]),
        "ui_action_cnt": lambda x: counts.action_counts(x.actions, W, [U, I, C]),
        "uc_action_cnt": lambda x: counts.action_counts(x.actions, W, [U, C]),
        "item_action_cnt": lambda x: counts.action_counts(x.actions, W, [I]),
        "ub_action_cnt": lambda x: counts.action_counts(x.actions, W, [U, B]),
        "brand_action_cnt": lambda x: counts.action_counts(x.actions, W, [B]),
        "bc_action_cnt": lambda x: counts.action_counts(x.actions, W, [B, C]),
        "user_timezone_cnt": lambda x: counts.time_zone_counts(x.actions, W, [U]),
        "uc_timezone_cnt": lambda x: counts.time_zone_counts(x.actions, W, [U, C], CATE),
        "ui_timezone_cnt": lambda x: counts.time_zone_counts(x.actions, W, [U, I]),
        "user_login_matrix": lambda x: counts.login_matrix(x.actions, W),
        # totals and flags
        "user_total_cnt": lambda x: counts.user_total_counts(x.actions, W),
        "user_total_decay": lambda x: decay.user_decayed_totals(x.actions, W, x.curve()),
        "ui_total_cnt": lambda x: counts.total_counts(x.actions, W, [U, I, C]),
        "uc_total_cnt": lambda x: counts.total_counts(x.actions, W, [U, C]),
        "ub_total_cnt": lambda x: counts.total_counts(x.actions, W, [U, B]),
        "uc_total_decay": lambda x: decay.decayed_totals(x.actions, W, x.curve(), [U, C]),
        "ui_total_decay": lambda x: decay.decayed_totals(x.actions, W, x.curve(), [U, I]),
        "ui_action_bool": lambda x: counts.action_flags(x.actions, W, [U, I]),
        "uc_action_bool": lambda x: counts.action_flags(x.actions, W, [U, C]),
        "ub_action_bool": lambda x: counts.action_flags(x.actions, W, [U, B]),
        # decay
        "decay_curve": lambda x: x.curve(),
        "user_action_cnt_decay": lambda x: decay.decayed_counts(x.actions, W, x.curve(), [U]),
        "ui_action_cnt_decay": lambda x: decay.decayed_counts(x.actions, W, x.curve(), [U, I, C]),
        "uc_action_cnt_decay": lambda x: decay.decayed_counts(x.actions, W, x.curve(), [U, C]),
        # ratios
        "buy_conversion": lambda x: counts.buy_conversion(x.actions, W),
        "user_window_ratio": lambda x: counts.window_ratios(x.actions, W, S, [U]),
        "ui_window_ratio": lambda x: counts.window_ratios(x.actions, W, S, [U, I]),
        "uc_window_ratio": lambda x: counts.window_ratios(x.actions, W, S, [U, C], CATE),
        "uc_all_ratio": lambda x: counts.cate_share_of_user(x.actions, W, S, CATE),
        "ui_uc_share": lambda x: counts.item_share_of_cate(x.actions, W),
        # distinct counts
        "user_active_days": lambda x: distinct.active_days(x.actions, W, [U]),
        "ui_active_days": lambda x: distinct.active_days(x.actions, W, [U, I]),
        "uc_active_days": lambda x: distinct.active_days(x.actions, W, [U, C], CATE),
        "user_cate_nitem": lambda x: distinct.distinct_count(x.actions, W, [U, C], I, "item_cnt", CATE),
        "uc_distinct_items": lambda x: distinct.distinct_items_by_type(x.actions, W),
        "item_people_flow": lambda x: distinct.distinct_count(x.actions, W, [I], U, "user_cnt"),
        "brand_people_flow": lambda x: distinct.distinct_count(x.actions, W, [B], U, "user_cnt"),
        "ui_model_clicks": lambda x: distinct.distinct_count(x.actions, W, [U, I], "model_id", "model_cnt"),
        "item_flow_sketched": _sketched_flow,
        "uc_only_cate": lambda x: distinct.only_category(x.actions, S, CATE),
        "icb_table": lambda x: distinct.item_category_brand(x.actions, W),
        # recency
        "user_first_dist": lambda x: recency.first_distance(x.actions, W, [U]),
        "user_last_dist": lambda x: recency.last_distance(x.actions, W, [U]),
        "ui_first_dist": lambda x: recency.first_distance(x.actions, W, [U, I]),
        "ui_last_dist": lambda x: recency.last_distance(x.actions, W, [U, I]),
        "ui_type_last_dist": lambda x: recency.last_distance_by_type(x.actions, W, [U, I]),
        "uc_last_dist": lambda x: recency.last_distance(x.actions, W, [U, C], CATE),
        "uc_type_last_dist": lambda x: recency.type_last_distance(x.actions, W, [U, C], CART, CATE),
        "uc_type_second_dist": lambda x: recency.type_second_distance(x.actions, W, [U, C], CART, CATE),
        "user_base_feat": lambda x: recency.user_base(
            x.users, W.end, cfg.DEFAULT_REG, cfg.REG_CUTOFF
        ),
        # sequences
        "user_dwell": lambda x: sequence.dwell(x.actions, W, [U], cfg.MAX_GAP),
        "ui_dwell": lambda x: sequence.dwell(x.actions, W, [U, I], cfg.MAX_GAP),
        "uc_dwell": lambda x: sequence.dwell(x.actions, W, [U, C], cfg.MAX_GAP),
        "user_dwell_180s": lambda x: sequence.dwell(x.actions, W, [U]),
        "ui_visit_runs": lambda x: sequence.visit_runs(x.actions, W),
        "user_visit_runs": lambda x: sequence.user_visit_runs(x.actions, W, CATE),
        "user_max_burst": lambda x: sequence.bursts(x.actions, S).select(U, "max_burst"),
        "user_mean_burst": lambda x: sequence.bursts(x.actions, S).select(U, "mean_burst"),
        # labels, candidates, rules
        "label_pairs": lambda x: labels.label_pairs(x.actions, cfg.LABEL),
        "label_pairs_sub": lambda x: x.pair_positives(),
        "eval_split": lambda x: labels.eval_split(x.actions, cfg.LABEL),
        "eval_split_sub": lambda x: x.positives(),
        "candidate_users": lambda x: labels.candidate_users(x.actions, W, CATE, positives=x.positives()),
        "candidate_pairs": lambda x: labels.candidate_pairs(
            x.actions, W, CATE, positives=x.pair_positives()
        ),
        "rule_users": lambda x: labels.rule_users(x.actions, x.users, W, S, CATE),
        "rule_users_loose": lambda x: labels.rule_users(x.actions, x.users, W, S, CATE, 0.3, 0),
        "rule_users_v1": lambda x: labels.rule_users_whole_log(
            x.actions, x.users, W, S, CATE, 0.3, 0
        ),
        "one_day_buyers": lambda x: labels.one_day_buyers(x.actions, W.back(days=3)),
        # items and brands
        "comment_asof": lambda x: items.comment_snapshot(x.comments, cfg.COMMENT_END),
        "item_attr_onehot": lambda x: items.attribute_onehot(x.products),
        "top_items_flag": lambda x: items.flag_top(
            _keyed_pairs(x), items.top_by_buys(x.actions, S, CATE, I), I, "top_item"
        ),
        "top_brands_flag": lambda x: items.flag_top(
            _keyed_pairs(x), items.top_by_buys(x.actions, S, CATE, B), B, "top_brand"
        ),
        "item_flow_ratio": lambda x: items.flow_ratios(x.actions, W),
        "brand_bad_rate": lambda x: items.brand_bad_rate(x.actions, W, x.comments),
        "icb_sale_ratio": lambda x: items.sale_ratios(x.actions, W.end),
        # assembled tables
        "user_features": lambda x: uf.user_features(x.context(decayed=True), x.positives()),
        "user_day_ratios": lambda x: uf.user_day_ratios(x.context()),
        "user_cate_attention": lambda x: uf.user_cate_attention(x.context()),
        "user_dwell_ratios": lambda x: uf.user_dwell_ratios(x.context()),
        "uc_daily_means": lambda x: uf.uc_daily_means(x.context()),
        "other_cate_bought": lambda x: uf.other_categories_bought(x.context()),
        "uc_browse_click": lambda x: uf.uc_browse_click(x.context()),
        "pair_features": lambda x: pf.pair_features(x.context(decayed=True), x.pair_positives()),
        "ui_span": lambda x: pf.ui_span(x.context()),
        "ui_day_ratios": lambda x: pf.ui_day_ratios(x.context()),
        "ui_multi_window_cnt": lambda x: counts.action_counts_multi(
            x.actions,
            Suffixes.hours(W.end, pf.COUNT_HOURS),
            [U, I],
            (1, 2, 3, 5, 6),
            CATE,
        ),
        "ui_uc_totals": lambda x: pf.ui_uc_totals(x.context()),
        "ui_dwell_ratios": lambda x: pf.ui_dwell_ratios(x.context()),
        "ui_runs_multi": lambda x: pf.ui_runs_multi(x.context()),
        "ui_delcart_later": lambda x: pf.ui_delcart_later(x.context()),
        "ui_cart_share": lambda x: pf.ui_cart_share(x.context()),
        "ui_browse_click": lambda x: pf.ui_browse_click(x.context()),
        "ub_share": lambda x: pf.ub_share(x.context()),
        "item_features": lambda x: pf.add_item_features(
            _keyed_pairs(x), pf.item_table(x.context())
        ),
        "brand_features": lambda x: pf.add_brand_features(_keyed_pairs(x), x.context()),
        "sku_features": lambda x: pf.sku_features(x.context(decayed=True), x.pair_positives()),
        "training_table": lambda x: pf.training_table(x.context(decayed=True), x.pair_positives()),
        "user_features_bucketed": _bucketed_users,
        "user_features_csv": _users_from_csv,
        "user_split_table": lambda x: _split_table(x, split_tables.user_split_table),
        "pair_split_table": lambda x: _split_table(x, split_tables.pair_split_table),
        "rolling_splits": lambda x: splits.split_candidates(
            x.actions,
            x.products,
            x.users,
            CATE,
            splits.rolling_splits(
                W.end, cfg.SPLIT_DAYS, cfg.SPLIT_LABEL_DAYS, cfg.SPLIT_STEP_DAYS
            ),
        ),
        # ranking and evaluation
        "argmax_item": lambda x: ranking.best_items(x.scores([U, I])),
        "fuse_submission": lambda x: x.submission(),
        "eval_f11": lambda x: evaluation.eval_f11(x.submission(), x.positives()),
        "eval_f12": lambda x: evaluation.eval_f12(x.submission(), x.positives()),
        "eval_score": lambda x: evaluation.eval_score(x.submission(), x.positives()),
        "eval_score_ab": lambda x: evaluation.eval_score_by_board(x.submission(), x.positives()),
    }


def _user_table(x: Inputs, window: WindowSpec, labelled: bool = True) -> DataFrame:
    positives = None
    if labelled:
        label = window.ahead(days=cfg.SPLIT_LABEL_DAYS)
        positives = labels.label_users(x.actions, label, x.products, x.users)
    return uf.user_features(x.context(window, decayed=True), positives)


def _train_split() -> WindowSpec:
    return W.shift(days=-cfg.SPLIT_STEP_DAYS)


def _pair_table(x: Inputs, window: WindowSpec, labelled: bool = True) -> DataFrame:
    positives = None
    if labelled:
        label = window.ahead(days=cfg.SPLIT_LABEL_DAYS)
        positives = labels.label_pairs_known(x.actions, label, x.products, x.users)
    return pf.training_table(x.context(window, decayed=True), positives)


def _scored(df: DataFrame) -> DataFrame:
    """Keys and whether their score is a probability: the part of a scored table that SQL can state."""
    keys = [c for c in (U, I) if c in df.columns]
    return df.select(*keys, F.col("score").between(0, 1).alias("is_probability"))


def _train_user_model(x: Inputs) -> DataFrame:
    """Scores of the training split under a model fitted on it; the table is written once for both."""
    table = materialise(_user_table(x, _train_split()))
    return _scored(models.score(models.train(table, models.USER_MODEL), table))


def _train_sku_model(x: Inputs) -> DataFrame:
    table = materialise(_pair_table(x, _train_split()))
    return _scored(models.score(models.train(table, models.PAIR_MODEL), table))


def _online_scores(x: Inputs, pairs: bool, best_round: bool = False) -> DataFrame:
    """Model of the training split, saved, loaded again and applied to the online split."""
    build, params = (_pair_table, models.PAIR_MODEL) if pairs else (_user_table, models.USER_MODEL)
    folder, table = scratch_folder(x.tables.spark), build(x, _train_split())
    if best_round:
        search = models.PAIR_SEARCH if pairs else models.USER_SEARCH
        most = replace(params, rounds=search["rounds"])
        model, _ = models.train_best(table, most, cfg.MODEL_FOLDS, search["patience"])
    else:
        model = models.train(table, params)
    models.save_model(model, folder)
    return models.score_saved(folder, build(x, W, labelled=False))


def _model_submission(x: Inputs) -> DataFrame:
    """Both saved models' scores of the online split, fused; the models stop at their best round. The scores are
    written before the fusion, which reads them several times."""
    pairs = materialise(_online_scores(x, pairs=True, best_round=True).select(U, I, "score"))
    users = materialise(_online_scores(x, pairs=False, best_round=True))
    return materialise(ranking.fuse_rankings(pairs, users, cfg.TOP_RANKED))


def _cv_best_rounds(x: Inputs) -> DataFrame:
    params = replace(models.USER_MODEL, rounds=cfg.MODEL_ROUNDS)
    losses = models.cv_round_losses(_user_table(x, _train_split()), params, cfg.MODEL_FOLDS)
    return losses.select("round", (F.col("loss") > 0).alias("has_loss"))


def _stopped_rounds(x: Inputs) -> DataFrame:
    """Whether several folds were grown, to rounds that they may grow to, and one stopped before the last."""
    params = replace(models.USER_MODEL, rounds=cfg.STOPPED_ROUNDS, rate=0.3)
    table = _user_table(x, _train_split())
    grown = models.stopped_rounds(table, params, cfg.MODEL_FOLDS, cfg.STOP_TOLERANCE)
    return grown.agg(
        F.count("*").between(2, cfg.MODEL_FOLDS).alias("several_folds"),
        F.min(F.col("rounds").between(1, cfg.STOPPED_ROUNDS)).alias("in_range"),
        (F.min("rounds") < cfg.STOPPED_ROUNDS).alias("stopped"),
    )


def _submission_facts(x: Inputs) -> DataFrame:
    """What is known of the submission whatever the models' scores: a row per user, all candidate pairs, and as
    many as the two top lists can give."""
    made = _model_submission(x)
    pairs = _keyed_pairs(x).select(U, I)
    known = made.join(pairs, [U, I], "left_semi").agg(F.count("*").alias("known"))
    of_all = pairs.agg(F.count_distinct(U).alias("users"))
    held = made.agg(F.count("*").alias("rows"), F.count_distinct(U).alias("row_users"))
    facts = held.join(known).join(of_all)  # one row each
    top = F.least("users", F.lit(cfg.TOP_RANKED))
    return facts.select(
        (F.col("rows") == F.col("row_users")).alias("one_per_user"),
        (F.col("rows") == F.col("known")).alias("all_candidates"),
        F.col("rows").between(top, F.least("users", 2 * top)).alias("full_lists"),
        "users",
    )


def _staged_search(x: Inputs) -> DataFrame:
    """All stages with few values each: points per stage and whether each has a held-out area."""
    start = replace(models.SEARCH_START, rounds=2)
    stages = tuple(models.SearchStage(grid) for grid in cfg.SEARCH_GRIDS)
    tried = models.staged_search(_user_table(x, _train_split()), start, stages, cfg.MODEL_FOLDS)[1]
    return tried.groupBy("stage").agg(
        F.count("*").alias("points"), F.min(F.col("auc").between(0, 1)).alias("is_area")
    )


def _topics(x: Inputs) -> DataFrame:
    rows = scan_window(x.actions, W, columns=[U, I])
    mix = models.topic_features(rows, U, I, cfg.TOPICS, cfg.TOPIC_ROUNDS)
    total = sum(F.col(f"topic_{i}") for i in range(cfg.TOPICS))
    return mix.select(U, F.round(total, 3).alias("topic_sum"))


def _models() -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        "train_user_model": _train_user_model,
        "train_sku_model": _train_sku_model,
        "cv_best_rounds": _cv_best_rounds,
        "stopped_rounds": _stopped_rounds,
        "staged_search": _staged_search,
        "score_users": lambda x: _scored(_online_scores(x, pairs=False)),
        "score_pairs": lambda x: _scored(_online_scores(x, pairs=True)),
        "model_submission": _model_submission,
        "submission_facts": _submission_facts,
        "model_score": lambda x: evaluation.eval_score(_model_submission(x), x.positives()),
    }


def _registered(build: Callable[[Inputs], DataFrame], inputs: type[Inputs] = Inputs) -> Query:
    return lambda spark, folder: comparable(build(inputs(spark, folder)))


def queries() -> dict[str, Query]:
    return {
        **{name: _registered(build) for name, build in _operators().items()},
        **{name: _registered(build, StagedInputs) for name, build in _models().items()},
        "topic_features": _registered(_topics),
    }
