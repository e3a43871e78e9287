"""Contest scores of a prediction list against bought pairs.

Every function returns a lazy frame of one row (or one row per board); an undefined score (no hit at
all) is NULL. The prediction list is read once: it is marked with its hits by user and by pair, reduced
to counts, and met by the counts of the truth in one more aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwise.functions.aggregates import count_where
from cartwise.functions.exprs import Exprs, aggregate
from cartwise.functions.ratios import ratio_or_null

# Keys of each score, weights of precision and recall, and weights of the two scores.
KEYS = {"f11": ["user_id"], "f12": ["user_id", "sku_id"]}
WEIGHTS = {
    "f11": {"scale": 6, "recall": 5, "precision": 1},
    "f12": {"scale": 5, "recall": 2, "precision": 3},
}
USER_WEIGHT, PAIR_WEIGHT = 0.4, 0.6

_ALL = {"all": "true"}
_BOARDS = {"A": "board = 'A'", "B": "board = 'B'"}


def _tally(pred: DataFrame, real: DataFrame, scores: tuple[str, ...], groups: dict[str, str]) -> DataFrame:
    """One row: `preds`, and per group `reals_<g>` and `<score>_<g>` hits.

    Predictions are counted as rows and may not repeat; a prediction hits once however often its key
    occurs in the truth.
    """
    marked = pred.select("user_id", "sku_id")
    for score in scores:
        marks = {f"{score}_{g}": f"max(if({cond}, 1, 0))" for g, cond in groups.items()}
        marked = marked.join(aggregate(real, KEYS[score], marks), KEYS[score], "left")
    hits = {f"{s}_{g}": f"coalesce(sum({s}_{g}), 0)" for s in scores for g in groups}
    reals = {f"reals_{g}": count_where(cond) for g, cond in groups.items()}
    both = aggregate(marked, [], {"preds": "count(1)", **hits}).unionByName(
        aggregate(real, [], reals), allowMissingColumns=True
    )
    return aggregate(both, [], {c: f"sum({c})" for c in both.columns})


def _quality(score: str, group: str) -> Exprs:
    """Precision, recall and the score itself over a tally."""
    p = ratio_or_null(f"{score}_{group}", "preds")
    r = ratio_or_null(f"{score}_{group}", f"reals_{group}")
    w = WEIGHTS[score]
    f = ratio_or_null(f"{w['scale']} * {p} * {r}", f"{w['recall']} * {r} + {w['precision']} * {p}")
    return {f"{score}_precision": p, f"{score}_recall": r, score: f}


def _one(pred: DataFrame, real: DataFrame, score: str) -> DataFrame:
    quality = _quality(score, "all")
    return _tally(pred, real, (score,), _ALL).selectExpr(*[f"{sql} AS {c}" for c, sql in quality.items()])


def eval_f11(pred: DataFrame, real: DataFrame) -> DataFrame:
    """User score; recall divides by the rows of `real`, not its distinct users."""
    return _one(pred, real, "f11")


def eval_f12(pred: DataFrame, real: DataFrame) -> DataFrame:
    """Pair score."""
    return _one(pred, real, "f12")


def _both(group: str) -> Exprs:
    f11, f12 = (_quality(score, group)[score] for score in KEYS)
    return {"f11": f11, "f12": f12, "score": f"{USER_WEIGHT}D * {f11} + {PAIR_WEIGHT}D * {f12}"}


def eval_score(pred: DataFrame, real: DataFrame) -> DataFrame:
    """Both scores and their weighted sum."""
    return _tally(pred, real, tuple(KEYS), _ALL).selectExpr(
        *[f"{sql} AS {name}" for name, sql in _both("all").items()]
    )


def eval_score_by_board(pred: DataFrame, real: DataFrame) -> DataFrame:
    """Scores per A/B board; precision always divides by all predictions."""
    rows = []
    for g in _BOARDS:
        fields = ", ".join(f"'{name}', {sql}" for name, sql in _both(g).items())
        rows.append(f"named_struct('board', '{g}', {fields})")
    tally = _tally(pred, real, tuple(KEYS), _BOARDS)
    return tally.selectExpr(f"inline(array({', '.join(rows)}))")
