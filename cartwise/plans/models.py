"""Purchase-intent models: boosted trees on the feature tables, tuning, scoring and topic features.

Features enter as one vector; NULL (a window without rows) becomes -1, outside the range of every
feature, so trees can split on absence.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import LDA
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.sources.sinks import materialise, scratch_folder

MISSING = -1.0
LABEL, FEATURES, WEIGHT, FOLD = "label", "features", "row_weight", "fold"
BUCKETS = 4096  # of the numbering of words
KEY_COLUMNS = ("user_id", "sku_id", "cate", "brand", LABEL)


@dataclass(frozen=True)
class BoostingParams:
    """Boosted-tree settings. Column sampling is per tree node, as Spark's trees define it.

    `min_gain` is Spark's: what a split takes off the variance, per unit of row weight. `min_drop` is what it must
    take off the loss of all rows, as other boosters state it.
    """

    rounds: int
    depth: int = 3
    rate: float = 0.01
    row_sample: float = 0.8
    column_sample: float = 0.8
    min_rows: int = 1
    min_gain: float = 0.0
    min_drop: float = 0.0
    positive_weight: float = 1.0
    seed: int = 6


# Tuned settings of the two models, and how far the search for the best round may go.
USER_MODEL = BoostingParams(rounds=1200)
PAIR_MODEL = BoostingParams(
    rounds=1378, row_sample=0.88, column_sample=0.76, min_rows=3, min_drop=0.4, positive_weight=1.2
)
USER_SEARCH = {"rounds": 3000, "patience": 20}
PAIR_SEARCH = {"rounds": 5000, "patience": 50}


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEY_COLUMNS]


def classifier(p: BoostingParams) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL,
        featuresCol=FEATURES,
        weightCol=WEIGHT,
        maxIter=p.rounds,
        maxDepth=p.depth,
        stepSize=p.rate,
        subsamplingRate=p.row_sample,
        featureSubsetStrategy=str(p.column_sample),
        minInstancesPerNode=p.min_rows,
        minInfoGain=p.min_gain,
        seed=p.seed,
    )


def with_drop(p: BoostingParams, rows: DataFrame) -> BoostingParams:
    """The settings with `min_drop` as a `min_gain` on these prepared rows.

    Spark's residuals are four times the gradients g of other boosters and its gain is a mean over the sampled
    weight w, while theirs sums g^2 / h with h = 1/4 per row at even odds, where growth begins: drop = gain * w / 4.
    """
    if not p.min_drop:
        return p
    weight = rows.agg(F.sum(WEIGHT)).first()[0] or 1.0
    return replace(p, min_gain=max(p.min_gain, 4 * p.min_drop / (p.row_sample * weight)), min_drop=0.0)


def assembler(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=FEATURES)


def dense(df: DataFrame, columns: list[str]) -> DataFrame:
    """All features as doubles without NULL, in one projection."""
    rest = [c for c in df.columns if c not in set(columns)]
    return df.selectExpr(
        *[f"`{c}`" for c in rest], *[f"coalesce(cast(`{c}` AS DOUBLE), {MISSING}D) AS `{c}`" for c in columns]
    )


def prepare(table: DataFrame, positive_weight: float = 1.0) -> DataFrame:
    """Key columns, label, row weight and the feature vector.

    Trees pass over the rows once per level, so the prepared rows are checkpointed in the shared folder.
    """
    columns = feature_columns(table)
    weight = F.when(F.col(LABEL) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    rows = assembler(columns).transform(dense(table, columns)).withColumn(WEIGHT, weight)
    keys = [c for c in KEY_COLUMNS if c in table.columns]
    vectors = rows.select(*keys, WEIGHT, FEATURES)
    return materialise(vectors)


def train(table: DataFrame, params: BoostingParams) -> PipelineModel:
    """Model over raw feature columns: assembly and boosted trees."""
    columns = feature_columns(table)
    rows = prepare(table, params.positive_weight)
    fitted = classifier(with_drop(params, rows)).fit(rows)
    return PipelineModel(stages=[assembler(columns), fitted])


def score(model: PipelineModel, table: DataFrame) -> DataFrame:
    """Keys and `score`, the probability of a purchase."""
    columns = model.stages[0].getInputCols()
    keys = [c for c in KEY_COLUMNS if c in table.columns and c != LABEL]
    scored = model.transform(dense(table, columns))
    return scored.select(*keys, vector_to_array("probability")[1].alias("score"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score_saved(path: str, table: DataFrame) -> DataFrame:
    """Scores a table with a model written by `save_model`."""
    return score(PipelineModel.load(path), table)


def with_folds(rows: DataFrame, folds: int, keys: list[str]) -> DataFrame:
    """Fold number from a hash of the key: stable across runs and partitionings."""
    return rows.withColumn(FOLD, F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int"))


def fold_rows(table: DataFrame, params: BoostingParams, folds: int) -> tuple[DataFrame, list[int]]:
    """Prepared rows with their fold, and the folds that have rows."""
    keys = [c for c in ("user_id", "sku_id") if c in table.columns]
    rows = with_folds(prepare(table, params.positive_weight), folds, keys)
    filled = sorted(r[FOLD] for r in rows.select(FOLD).distinct().collect())
    if len(filled) < 2:
        raise ValueError("cross-validation needs rows in at least two folds")
    return rows, filled


def round_losses(rows: DataFrame, filled: list[int], params: BoostingParams, parallelism: int) -> list[float]:
    """Held-out logistic loss after each round, averaged over the folds, which are fitted side by side."""

    def held_out_losses(fold: int) -> list[float]:
        others = rows.filter(F.col(FOLD) != fold)
        model: GBTClassificationModel = classifier(with_drop(params, others)).fit(others)
        return model.evaluateEachIteration(rows.filter(F.col(FOLD) == fold))

    with ThreadPoolExecutor(parallelism) as pool:
        losses = list(pool.map(inheritable_thread_target(rows.sparkSession)(held_out_losses), filled))
    return [sum(at) / len(filled) for at in zip(*losses, strict=True)]


def cv_round_losses(
    table: DataFrame, params: BoostingParams, folds: int = 5, parallelism: int = 4
) -> DataFrame:
    """`(round, loss)`: held-out logistic loss after each round, averaged over the folds.

    One model per fold is grown to the full number of rounds and evaluated after each of them. Folds are
    fitted side by side; a fold without rows has no loss and is left out.
    """
    rows, filled = fold_rows(table, params, folds)
    means = list(enumerate(round_losses(rows, filled, params, parallelism), 1))
    return table.sparkSession.createDataFrame(means, "round int, loss double")


HELD_OUT = "held_out"


def stopped_rounds(
    table: DataFrame, params: BoostingParams, folds: int = 5, tolerance: float = 0.001, parallelism: int = 4
) -> DataFrame:
    """`(fold, rounds, loss)`: how many rounds each fold's model grows until its held-out loss no longer falls by
    more than the share `tolerance`, and that loss.

    Growth itself stops, with the fold's rows as validation rows, so rounds that would not be used are never grown;
    `cv_round_losses` grows all rounds and looks back, which shows the whole curve.
    """
    rows, filled = fold_rows(table, params, folds)

    def grown(fold: int) -> tuple[int, int, float]:
        marked = rows.withColumn(HELD_OUT, F.col(FOLD) == fold)
        settings = with_drop(params, marked.filter(~F.col(HELD_OUT)))
        stopping = classifier(settings).setValidationIndicatorCol(HELD_OUT)
        model: GBTClassificationModel = stopping.fit(marked, {stopping.validationTol: tolerance})
        losses = model.evaluateEachIteration(marked.filter(HELD_OUT))
        return fold, model.getNumTrees, float(losses[-1])

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(inheritable_thread_target(table.sparkSession)(grown), filled))
    return table.sparkSession.createDataFrame(found, "fold int, rounds int, loss double")


def train_stopped(
    table: DataFrame, params: BoostingParams, folds: int = 5, tolerance: float = 0.001
) -> tuple[PipelineModel, int]:
    """Model retrained on all rows with the mean of the rounds at which the folds stopped, and that number.

    The table is written once; the folds and the last fit read it.
    """
    table = materialise(table)
    grown = [r["rounds"] for r in stopped_rounds(table, params, folds, tolerance).collect()]
    rounds = max(1, round(sum(grown) / len(grown)))
    return train(table, replace(params, rounds=rounds)), rounds


FIRST_ROUNDS, GROWTH = 100, 3  # of the search for the best round: where the folds stop at first, and next


def best_rounds(losses: list[float], patience: int = 20) -> int:
    """Round of the lowest loss before `patience` rounds pass without a new low."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def train_best(
    table: DataFrame, params: BoostingParams, folds: int = 5, patience: int = 20
) -> tuple[PipelineModel, int]:
    """Model retrained on all rows at the best cross-validated round, and that round.

    The table is written once; the folds and the last fit read it. A model of few rounds is the beginning of one of
    many, so the folds grow to FIRST_ROUNDS and, as long as `patience` has not passed, again to a multiple of it:
    rounds after the patience cannot change the best one.
    """
    table = materialise(table)
    rows, filled = fold_rows(table, params, folds)
    grown, rounds = 0, 1
    while grown < params.rounds and grown - rounds < patience:
        grown = min(params.rounds, GROWTH * grown or FIRST_ROUNDS)
        rounds = best_rounds(round_losses(rows, filled, replace(params, rounds=grown), folds), patience)
    return train(table, replace(params, rounds=rounds)), rounds


@dataclass(frozen=True)
class SearchStage:
    """One stage of the search: parameter names of `BoostingParams` and the values to try."""

    grid: dict[str, tuple[float, ...]] = field(default_factory=dict)


# The staged grid. The penalty stage has no counterpart in Spark's trees.
SEARCH_STAGES = (
    SearchStage({"depth": (3, 4, 5, 6), "min_rows": (1, 3)}),
    SearchStage({"min_gain": (0.0, 0.2, 0.4)}),
    SearchStage({"row_sample": (0.6, 0.7, 0.8), "column_sample": (0.6, 0.7, 0.8)}),
    SearchStage({"positive_weight": (0.5, 1.0, 2.0)}),
    SearchStage({"rate": (0.01, 0.05, 0.1, 0.2), "rounds": (800, 1000, 1200)}),
)
SEARCH_START = BoostingParams(rounds=150, depth=5, rate=0.3)

_GRID_PARAMS = {
    "depth": "maxDepth",
    "min_rows": "minInstancesPerNode",
    "min_gain": "minInfoGain",
    "row_sample": "subsamplingRate",
    "column_sample": "featureSubsetStrategy",
    "rate": "stepSize",
    "rounds": "maxIter",
}


def staged_search(
    table: DataFrame,
    start: BoostingParams = SEARCH_START,
    stages: tuple[SearchStage, ...] = SEARCH_STAGES,
    folds: int = 5,
    parallelism: int = 4,
) -> tuple[BoostingParams, DataFrame]:
    """Tunes stage by stage on ROC-AUC, each stage starting from the best values so far.

    Returns the final settings and `(stage, params, auc)` for every point tried.
    """
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    keys = [c for c in ("user_id", "sku_id") if c in table.columns]
    rows = with_folds(prepare(table), folds, keys)
    best, tried = start, []
    for number, stage in enumerate(stages, 1):
        points = []
        for weight in stage.grid.get("positive_weight", (best.positive_weight,)):
            settings = replace(best, positive_weight=weight)
            estimator = classifier(settings)
            grid = ParamGridBuilder()
            for name, values in stage.grid.items():
                if name != "positive_weight":
                    cast = str if name == "column_sample" else (lambda v: v)
                    grid = grid.addGrid(getattr(estimator, _GRID_PARAMS[name]), [cast(v) for v in values])
            weighted = rows.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, float(weight)).otherwise(1.0))
            maps = grid.build()
            jobs = [(point, fold) for point in range(len(maps)) for fold in range(folds)]

            def held_out_auc(job, maps=maps, weighted=weighted, estimator=estimator) -> float:
                point, fold = job
                model = estimator.fit(weighted.filter(F.col(FOLD) != fold), maps[point])
                return evaluator.evaluate(model.transform(weighted.filter(F.col(FOLD) == fold)))

            # Folds and points are fitted side by side; the winner is not refitted, only its settings go on.
            with ThreadPoolExecutor(parallelism) as pool:
                aucs = list(pool.map(inheritable_thread_target(table.sparkSession)(held_out_auc), jobs))
            names = {spark_name: name for name, spark_name in _GRID_PARAMS.items()}
            for i, point in enumerate(maps):
                auc = sum(aucs[i * folds : (i + 1) * folds]) / folds
                chosen = {names[p.name]: v for p, v in point.items()}
                if "column_sample" in chosen:
                    chosen["column_sample"] = float(chosen["column_sample"])
                points.append((replace(settings, **chosen), float(auc)))
        best = max(points, key=lambda point: point[1])[0]
        tried += [(number, str(settings), auc) for settings, auc in points]
    return best, table.sparkSession.createDataFrame(tried, "stage int, params string, auc double")


def word_numbers(words: DataFrame, column: str) -> DataFrame:
    """(`column`, word) of each distinct value: numbers from 0 without gaps, made without gathering the values.

    A value's number is its rank inside a hash bucket plus the sizes of the buckets before it; the bucket table
    has BUCKETS rows at most.
    """
    keyed = words.select(column).where(F.col(column).isNotNull()).distinct()
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64(column), F.lit(BUCKETS)))
    in_order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"))
    offsets = sizes.select("bucket", F.coalesce(F.sum("held").over(in_order), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy(column))
    ranked = keyed.withColumn("inside", inside).join(F.broadcast(offsets), "bucket")
    return ranked.select(column, (F.col("before") + F.col("inside") - 1).cast("int").alias("word"))


def bags_of_words(actions: DataFrame, document: str, word: str) -> DataFrame:
    """(`document`, features): how often each document has each word, as sparse vectors, written once.

    A sparse vector is a struct of its size, indices and values; the column is built as that struct by SQL
    functions and read back under the vector type, so no row passes through Python.
    """
    numbered = materialise(word_numbers(actions, word))
    size = numbered.count()
    counted = (
        actions.join(numbered, word)
        .groupBy(document, "word")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    bags = counted.groupBy(document).agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("bag"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.col("bag.word").alias("indices"),
        F.col("bag.n").alias("values"),
    )
    folder = scratch_folder(actions.sparkSession)
    bags.select(document, vector.alias(FEATURES)).write.parquet(folder)
    schema = T.StructType([actions.schema[document], T.StructField(FEATURES, VectorUDT())])
    return actions.sparkSession.read.schema(schema).parquet(folder)


def topic_features(
    actions: DataFrame,
    document: str,
    word: str,
    topics: int,
    iterations: int,
    prefix: str = "topic_",
    seed: int = 0,
) -> DataFrame:
    """Topic mix per `document` entity, with the `word` entities it acted on as its words.

    Words are counted per document before they are gathered, so a document holds each vocabulary entry at
    most once however many actions it has. LDA itself keeps a topics x vocabulary matrix on the driver.
    """
    vectors = bags_of_words(actions, document, word)
    model = LDA(k=topics, maxIter=iterations, seed=seed, featuresCol=FEATURES, optimizer="online").fit(vectors)
    mix = vector_to_array("topicDistribution")
    return model.transform(vectors).select(
        document, *[mix[i].alias(f"{prefix}{i}") for i in range(topics)]
    )
