"""The two whole runs: training and batch scoring."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.labels import DECISION_THRESHOLD
from ledgerlens.operators import drift
from ledgerlens.operators.cleaning import clean, pass_through
from ledgerlens.operators.features import EXTENDED, EXTENDED_SCALED, FEATURES, SCALED, extended_features, features, fit_context
from ledgerlens.operators.metrics import batch_summary, evaluation_report
from ledgerlens.operators.models import (
    BOOSTING_ROUNDS,
    LABEL,
    estimator_of,
    random_search,
    train,
    with_decision,
    with_score,
)
from ledgerlens.operators.profiles import Profiles
from ledgerlens.operators.sampling import smote, stratified_split, with_class_weight
from ledgerlens.operators.scaling import Scaler, apply_scaler, fit_scaler
from ledgerlens.operators.small import settled
from ledgerlens.operators.validation import validate
from ledgerlens.sources import runlog, state
from ledgerlens.sources.contract import ID_COLUMNS, SCORING_COLUMNS
from ledgerlens.sources.files import require_columns, require_rows, write_csv, write_json

THRESHOLDS = [0.3, 0.33]
# Rows of a training matrix in one file: training reads it every round, and a round over few rows is all job start.
MATRIX_ROWS = 250_000


@dataclass(frozen=True)
class Prepared:
    """What training needs: the state and the written matrices."""

    profiles: Profiles
    scaler: Scaler
    train: DataFrame
    test: DataFrame


@dataclass(frozen=True)
class Derived:
    """What every training matrix starts from: the state, and the features before scaling, written."""

    profiles: Profiles
    scaler: Scaler
    columns: list[str]
    train: DataFrame
    test: DataFrame


def prepare(
    tx: DataFrame, root: str, fit_on: str = "train", oversample: bool = True, test_size: float = 0.2, extended: bool = False
) -> Prepared:
    """Split, fit the profiles, derive, scale and oversample; every part is written below ``root``."""
    return matrices(derive(tx, root, fit_on, test_size, extended), root, oversample)


def derive(tx: DataFrame, root: str, fit_on: str = "train", test_size: float = 0.2, extended: bool = False) -> Derived:
    """Split, fit the profiles, derive the features and fit the scaler.

    ``fit_on="all"`` fits the profiles on all rows before the split; that lets test rows leak into the profiles, so
    the default fits on the training rows. ``extended`` derives the exploratory feature list.
    """
    spark = tx.sparkSession
    train_rows, test_rows = stratified_split(tx, test_size)
    fitted_on = tx if fit_on == "all" else train_rows
    profiles = state.fit_and_save_profiles(fitted_on, f"{root}/profiles")
    keep = ["transaction_id", LABEL]
    context = fit_context(fitted_on) if extended else None
    columns, continuous = (EXTENDED, EXTENDED_SCALED) if extended else (FEATURES, SCALED)
    for name, rows in (("train", train_rows), ("test", test_rows)):
        derived = extended_features(rows, profiles, context, keep) if extended else features(rows, profiles, keep)
        state.save_table(derived, f"{root}/features/{name}")
    plain = {n: spark.read.parquet(f"{root}/features/{n}") for n in ("train", "test")}
    state.save_scaler(fit_scaler(plain["train"], continuous), f"{root}/scaler")
    return Derived(profiles, state.load_scaler(spark, f"{root}/scaler"), columns, plain["train"], plain["test"])


def matrix_files(rows: int, cores: int) -> int:
    """Files of a training matrix: one a task, and if it is several, then alike for every core."""
    files = max(1, math.ceil(rows / MATRIX_ROWS))
    return files if files == 1 else math.ceil(files / cores) * cores


def matrices(derived: Derived, root: str, oversample: bool = True) -> Prepared:
    """Scale and oversample; the matrices are written below ``root``. Several may start from the same derived features."""
    spark, scaler = derived.train.sparkSession, derived.scaler
    scaled = apply_scaler(derived.train, scaler)
    # Oversampling doubles the rows at most.
    files = matrix_files(derived.train.count() * (2 if oversample else 1), spark.sparkContext.defaultParallelism)
    matrix = smote(scaled, derived.columns) if oversample else scaled
    # Several files are dealt by id: dealing rows in turn would sort them all first, so that a retried task repeats itself.
    dealt = matrix.repartition(files, "transaction_id") if files > 1 else matrix.repartition(1)
    state.save_table(dealt, f"{root}/matrix/train")
    state.save_table(apply_scaler(derived.test, scaler), f"{root}/matrix/test")
    written = [spark.read.parquet(f"{root}/matrix/{n}") for n in ("train", "test")]
    return Prepared(derived.profiles, scaler, *written)


def train_and_evaluate(
    prepared: Prepared, root: str, run_id: str, estimator: Estimator | None = None, when: dt.datetime | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Train, write the model, and write and log the evaluation of the test rows."""
    model = train(prepared.train, FEATURES, estimator)
    model.write().overwrite().save(f"{root}/model")
    spark = prepared.test.sparkSession
    state.save_table(
        with_score(prepared.test, model).select("transaction_id", LABEL, "score"), f"{root}/test_scores"
    )
    report = evaluation_report(spark.read.parquet(f"{root}/test_scores"), THRESHOLDS)
    state.save_table(report, f"{root}/report")
    report = spark.read.parquet(f"{root}/report")
    rows = report.select(
        F.lit(run_id).alias("run_id"),
        F.lit("evaluate").alias("stage"),
        F.lit(type(model.stages[-1]).__name__).alias("model"),
        F.concat_ws("@", "metric", "threshold").alias("name"),
        "value",
        F.lit("").alias("params"),
        F.lit(when or dt.datetime.now(dt.timezone.utc)).alias("ts"),
    )
    runlog.append_metrics(rows, f"{root}/run_metrics")
    return model, report


def training_run(
    raw: DataFrame,
    root: str,
    run_id: str,
    estimator: Estimator | None = None,
    fit_on: str = "train",
    rounds: int = BOOSTING_ROUNDS,
) -> DataFrame:
    """Clean, validate, prepare, train, evaluate. Returns the evaluation report.

    Without an ``estimator`` boosted trees are trained with the parameters of the best trial that a search has logged
    below ``root`` (:func:`search_run`), else with the defaults.
    The first run stores a drift baseline; later runs store a drift report, which warns and never fails.
    """
    spark = raw.sparkSession
    cleaned = clean(require_rows(raw, "transactions"))
    validate(cleaned, f"{root}/validated")
    rows = spark.read.parquet(f"{root}/validated")
    baseline = state.load_table(spark, f"{root}/baseline")
    if baseline is None:
        state.save_table(drift.build_baseline(drift.baseline_sample(rows)), f"{root}/baseline")
    else:
        state.save_table(drift.check_drift(rows, baseline), f"{root}/drift")
    prepared = prepare(rows, root, fit_on)
    if estimator is None:
        params = runlog.resolve_params(state.load_table(spark, f"{root}/run_metrics"), {})
        estimator = estimator_of(params, rounds)
        if "positive_weight" in params:
            weighted = with_class_weight(prepared.train, params["positive_weight"], LABEL)
            prepared = replace(prepared, train=weighted)
    return train_and_evaluate(prepared, root, run_id, estimator)[1]


def search_run(
    train_rows: DataFrame, root: str, run_id: str, trials: list[dict], when: dt.datetime | None = None, **options
) -> DataFrame:
    """Search over ``trials`` (:func:`~ledgerlens.operators.models.random_search`) and log every one of them."""
    found = settled(random_search(train_rows, FEATURES, trials, **options))
    runlog.append_metrics(runlog.trial_rows(found, run_id, when or dt.datetime.now(dt.timezone.utc)), f"{root}/run_metrics")
    return found


def score_batch(
    batch: DataFrame,
    profiles: Profiles,
    scaler: Scaler,
    model: PipelineModel,
    batch_date: str,
    threshold: float = DECISION_THRESHOLD,
) -> DataFrame:
    """Id columns, ``score``, ``predicted_fraud`` and ``batch_date`` of every row of a batch.

    The stored state answers for each row alone: the batch is never aggregated, so its make-up cannot change a score.
    Ids ride along through the model; nothing is matched by position.
    """
    require_columns(batch, SCORING_COLUMNS)
    ids = pass_through(batch, ID_COLUMNS)
    scaled = apply_scaler(features(batch, profiles, ids), scaler)
    decided = with_decision(scaled, model, threshold)
    return decided.select(*ids, "score", "predicted_fraud", F.lit(batch_date).alias("batch_date"))


def scoring_run(batch: DataFrame, root: str, out: str, batch_date: str) -> DataFrame:
    """Score a batch with the state below ``root``; write predictions, drift report and metrics below ``out``."""
    spark = batch.sparkSession
    scored = score_batch(
        batch,
        state.load_profiles(spark, f"{root}/profiles"),
        state.load_scaler(spark, f"{root}/scaler"),
        PipelineModel.load(f"{root}/model"),
        batch_date,
    )
    state.save_table(scored, f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    write_csv(scored.withColumnRenamed("score", "fraud_score"), f"{out}/predictions")
    report = drift.check_drift(batch, state.load_table(spark, f"{root}/baseline"))
    write_json(report, f"{out}/monitoring")
    summary = batch_summary(scored)
    now = dt.datetime.now(dt.timezone.utc)
    runlog.append_metrics(runlog.metrics_of(summary, batch_date, "batch", now), f"{root}/run_metrics")
    return scored


def submission(scored: DataFrame) -> DataFrame:
    """The two columns of a submission."""
    return scored.select("transaction_id", "predicted_fraud")
