"""Training, search, scoring and attribution with Spark ML."""

from __future__ import annotations

import math
import random
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.functions.labels import DECISION_THRESHOLD, predicted_fraud
from ledgerlens.operators.metrics import ranking_metrics, threshold_sweep
from ledgerlens.operators.ordered import numbered, union_all
from ledgerlens.operators.sampling import SEED, smote, with_class_weight, with_fold
from ledgerlens.operators.small import settled
from ledgerlens.session import ensure_checkpoint_dir

LABEL = "is_fraud"
# Rounds and search ranges.
BOOSTING_ROUNDS = 200
SEARCH_TRIALS = 50
SEARCH_FOLDS = 3
SEARCH_ROUNDS = 300
# Ranges of the tree search: (low, high, logarithmic). Leaves 20-150 become depths 4-7 for depth-wise trees, and a
# fraction of columns becomes one for each tree node.
SEARCH_SPACE = {
    "maxDepth": (4, 7, False),
    "stepSize": (0.01, 0.3, True),
    "minInstancesPerNode": (10, 100, False),
    "subsamplingRate": (0.5, 1.0, False),
    "featureSubsetStrategy": (0.5, 1.0, False),
    "positive_weight": (10.0, 30.0, False),
}
WHOLE_NUMBERS = ("maxDepth", "minInstancesPerNode")
# Rows that one task scores where each row is scored many times: a shuffle is dealt by what it moves, not by what follows.
SCORED_ROWS = 200_000
# Models fitted at a time, and up to how many rows: a round of boosting is a chain of jobs, which over few rows are mostly job
# start and leave cores to another model; over many rows they fill the cores, and every model keeps its own copy of the rows.
FITS = 4
FITS_ROWS = 2_000_000


def gbt(rounds: int = BOOSTING_ROUNDS, seed: int = SEED, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=LABEL, featuresCol="features", maxIter=rounds, seed=seed, **params)


def random_forest(trees: int = 200, seed: int = SEED, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=LABEL, featuresCol="features", numTrees=trees, seed=seed, **params)


def logistic(max_iter: int = 1000, **params) -> LogisticRegression:
    return LogisticRegression(labelCol=LABEL, featuresCol="features", maxIter=max_iter, **params)


def pipeline(estimator: Estimator, columns: list[str]) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), estimator])


def train(df: DataFrame, columns: list[str], estimator: Estimator | None = None) -> PipelineModel:
    """Fit on a table of scaled features. The table should be a written one: boosting reads it every round."""
    return pipeline(estimator or gbt(), columns).fit(df)


def with_score(df: DataFrame, model: Model) -> DataFrame:
    """Add ``score``, the probability of the positive class."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def with_decision(df: DataFrame, model: Model, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    scored = with_score(df, model)
    return scored.withColumn("predicted_fraud", predicted_fraud(F.col("score"), threshold))


def evaluate(df: DataFrame, model: Model, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """One row: the ranking metrics and the metrics at the threshold."""
    scored = settled(with_score(df, model).select(LABEL, "score"))
    at = threshold_sweep(scored, [threshold])
    ranks = ranking_metrics(scored)
    row = ranks.select(F.struct("*").alias("r")).scalar()
    return at.withColumn("_r", row).select("_r.*", *at.columns)


@dataclass(frozen=True)
class Compared:
    name: str
    model: PipelineModel
    seconds: float


def fits_at_once(df: DataFrame) -> int:
    return FITS if df.count() <= FITS_ROWS else 1


def fit_models(df: DataFrame, columns: list[str], estimators: dict[str, Estimator]) -> list[Compared]:
    """The models in the order of the estimators; where some are fitted at a time, the seconds of each hold those beside it."""

    def fit(name: str) -> Compared:
        started = time.monotonic()
        model = train(df, columns, estimators[name])
        return Compared(name, model, time.monotonic() - started)

    with ThreadPoolExecutor(fits_at_once(df)) as pool:
        return list(pool.map(fit, estimators))


def compare_models(test: DataFrame, fitted: list[Compared], threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """One row a model: ranking metrics, metrics at the threshold and training time, from one table of all scores."""
    scored = settled(
        union_all(
            [with_score(test, m.model).select(F.lit(m.name).alias("model"), LABEL, "score") for m in fitted]
        )
    )
    timed = test.sparkSession.createDataFrame([(m.name, m.seconds) for m in fitted], "model string, train_seconds double")
    metrics = ranking_metrics(scored, ["model"]).join(threshold_sweep(scored, [threshold], ["model"]), "model")
    return metrics.join(timed, "model").orderBy(F.desc("roc_auc"))


def ablation(
    train_df: DataFrame,
    test: DataFrame,
    full: list[str],
    dropped: list[str],
    estimator: Estimator,
    threshold: float = DECISION_THRESHOLD,
) -> DataFrame:
    """``(metric, full, reduced, delta)`` of the same estimator with and without some features."""
    reduced = [c for c in full if c not in dropped]
    lists = {"full": full, "reduced": reduced}
    with ThreadPoolExecutor(fits_at_once(train_df)) as pool:
        models = dict(zip(lists, pool.map(lambda columns: train(train_df, columns, estimator), lists.values()), strict=True))
    scored = settled(
        union_all([with_score(test, m).select(F.lit(name).alias("model"), LABEL, "score") for name, m in models.items()])
    )
    table = ranking_metrics(scored, ["model"]).join(threshold_sweep(scored, [threshold], ["model"]), "model")
    names = ["roc_auc", "average_precision", "accuracy", "prec", "recall", "f1"]
    long = table.unpivot("model", names, "metric", "value")
    both = long.groupBy("metric").pivot("model", ["full", "reduced"]).agg(F.max("value"))
    return both.withColumn("delta", F.round(F.col("reduced") - F.col("full"), 6))


def metric_table(run_metrics: DataFrame, stages: list[str], metric: str = "roc_auc") -> DataFrame:
    """One row a model, one column a tuning stage, from logged metrics ``(model, stage, name, value)``."""
    return (
        run_metrics.where(F.col("name") == metric).groupBy("model").pivot("stage", stages).agg(F.max("value"))
    )


def importances(model: PipelineModel, columns: list[str], df: DataFrame) -> DataFrame:
    """``(feature, importance, share)`` of a tree model, highest first."""
    values = model.stages[-1].featureImportances.toArray()
    total = float(values.sum()) or 1.0
    rows = [(c, float(v), float(v) / total) for c, v in zip(columns, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double, share double")
    return table.orderBy(F.desc("importance"), "feature")


def top_features(importance: DataFrame, n: int) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def cross_validate(
    df: DataFrame, columns: list[str], estimator: Estimator, grid: list, folds: int = SEARCH_FOLDS, parallelism: int = 2
) -> CrossValidatorModel:
    """Mean ROC area of every parameter map over hash folds, which keep the class shares."""
    flow = pipeline(estimator, columns)
    validator = CrossValidator(
        estimator=flow,
        estimatorParamMaps=grid or [{}],
        # No bins: the exact area, as everywhere else.
        evaluator=BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC", numBins=0),
        foldCol="fold",
        numFolds=folds,
        parallelism=parallelism,
    )
    return validator.fit(df if "fold" in df.columns else with_fold(df, folds))


def grid(estimator: Estimator, options: dict[str, list]) -> list:
    builder = ParamGridBuilder()
    for name, values in options.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def grid_results(fitted: CrossValidatorModel) -> list[dict]:
    """One record a trial with its parameters, mean and deviation over the folds."""
    maps = [{p.name: v for p, v in m.items()} for m in fitted.getEstimatorParamMaps()]
    spread = fitted.stdMetrics or [None] * len(maps)
    return [
        {"trial": i, "params": m, "mean": float(a), "std": None if s is None else float(s)}
        for i, (m, a, s) in enumerate(zip(maps, fitted.avgMetrics, spread))
    ]


def random_trials(trials: int = SEARCH_TRIALS, seed: int = SEED, space: dict = SEARCH_SPACE) -> list[dict]:
    """A seeded list of parameter sets drawn from the ranges."""
    draw = random.Random(seed)
    out = []
    for _ in range(trials):
        params = {}
        for name, (low, high, logarithmic) in space.items():
            value = low * (high / low) ** draw.random() if logarithmic else draw.uniform(low, high)
            params[name] = int(round(value)) if name in WHOLE_NUMBERS else round(value, 6)
        out.append(params)
    return out


def estimator_of(params: dict, rounds: int = BOOSTING_ROUNDS) -> GBTClassifier:
    """Boosted trees with the parameters of a trial; ``positive_weight`` becomes a weight column."""
    rest = {k: int(v) if k in WHOLE_NUMBERS else v for k, v in params.items() if k != "positive_weight"}
    if "featureSubsetStrategy" in rest:
        rest["featureSubsetStrategy"] = str(rest["featureSubsetStrategy"])
    return gbt(rounds, **({"weightCol": "weight"} if "positive_weight" in params else {}), **rest)


def random_search(
    df: DataFrame,
    columns: list[str],
    trials: list[dict],
    folds: int = SEARCH_FOLDS,
    rounds: int = SEARCH_ROUNDS,
    resample: bool = False,
    parallelism: int = 2,
) -> DataFrame:
    """``(trial, params, mean_roc_auc, best_so_far)``: each trial's mean ROC area over the folds.

    ``df`` holds original rows. With ``resample`` positives are oversampled inside each training fold only; doing it
    before the folds would put relatives of the test rows into training and inflate the score. Each model's scores
    are appended to one table, so no plan grows with the number of trials.
    """
    spark = df.sparkSession
    placed = settled(with_fold(df, folds))
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    parts = []
    for fold in range(folds):
        inside, outside = placed.where(F.col("fold") != fold), placed.where(F.col("fold") == fold)
        parts.append((settled(smote(inside, columns)) if resample else inside, outside))

    def run(number: int, fold: int) -> None:
        inside, outside = parts[fold]
        params = trials[number]
        weighted = with_class_weight(inside, params.get("positive_weight", 1.0), LABEL)
        model = train(weighted, columns, estimator_of(params, rounds))
        with_score(outside, model).select(LABEL, "score").write.parquet(f"{path}/trial={number}/fold={fold}")

    with ThreadPoolExecutor(parallelism) as pool:
        jobs = [pool.submit(run, number, fold) for number in range(len(trials)) for fold in range(folds)]
        for job in jobs:
            job.result()
    areas = ranking_metrics(spark.read.parquet(path), ["trial", "fold"])
    means = areas.groupBy("trial").agg(F.round(F.avg("roc_auc"), 6).alias("mean_roc_auc"))
    named = spark.createDataFrame(
        [(i, {k: float(v) for k, v in p.items()}) for i, p in enumerate(trials)], "trial int, params map<string,double>"
    )
    return best_so_far(named.join(means, "trial"), "trial", "mean_roc_auc")


def best_so_far(trials: DataFrame, order: str, value: str) -> DataFrame:
    """Add the running maximum over the trials. The table has one row a trial."""
    upto = W.partitionBy(F.lit(0)).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", F.max(value).over(upto))


def permutation_importance(
    df: DataFrame, model: PipelineModel, columns: list[str], key: str = "transaction_id", seed: int = SEED
) -> DataFrame:
    """``(feature, roc_auc, drop)``: the ROC area lost when one feature's values are shuffled among the rows.

    Each row gets one donor row and takes the shuffled value from it. One join serves all features; the scored table
    then has one row per row and feature, so the join is dealt to as many tasks as these rows ask for.
    """
    rows = df.select(key, LABEL, F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    ranked = settled(numbered(rows, key, seed=seed))
    n = ranked.count()
    # Row numbers follow a hash, so the row a fixed distance ahead (round the end) is an unrelated one.
    ahead = F.col("row_number") + F.lit(max(1, int(n * 0.618)))
    donors = ranked.select(F.when(ahead > n, ahead - n).otherwise(ahead).alias("row_number"), F.col("x").alias("d"))
    tasks = max(1, math.ceil(n * (len(columns) + 1) / SCORED_ROWS))
    if tasks > 1:
        ranked, donors = (side.repartition(tasks, "row_number") for side in (ranked, donors))
    paired = ranked.join(donors, "row_number")
    cases = F.explode(F.sequence(F.lit(-1), F.lit(len(columns) - 1))).alias("case")
    mixed = paired.select(LABEL, "x", "d", cases)
    values = [
        F.when(F.col("case") == i, F.get("d", F.lit(i))).otherwise(F.get("x", F.lit(i))).alias(c)
        for i, c in enumerate(columns)
    ]
    scored = settled(with_score(mixed.select(LABEL, "case", *values), model).select("case", LABEL, "score"))
    areas = settled(ranking_metrics(scored, ["case"]).select("case", "roc_auc"))
    whole = areas.where("case = -1").agg(F.max("roc_auc")).scalar()
    names = F.array(*[F.lit(c) for c in columns])
    return areas.where("case >= 0").select(
        F.get(names, F.col("case")).alias("feature"),
        "roc_auc",
        F.round(whole - F.col("roc_auc"), 6).alias("drop"),
    )

