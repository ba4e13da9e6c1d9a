"""Named queries: training, search, scoring and streams. Most have no SQL; tests check their invariants."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.labels import DECISION_THRESHOLD
from ledgerlens.operators import attribution, logistic, models, sampling
from ledgerlens.operators.features import DROPPED_LATER, EXTENDED, FEATURES, extended_features, fit_context
from ledgerlens.operators.metrics import ranking_metrics, threshold_sweep
from ledgerlens.operators.ordered import union_all
from ledgerlens.operators.profiles import fit_profiles
from ledgerlens.operators.small import settled
from ledgerlens.plans.metric_queries import CURVE
from ledgerlens.plans.quality_queries import scratch
from ledgerlens.plans.registry import TX, profiles_sql, query
from ledgerlens.plans.runs import Derived, Prepared, derive, matrices, score_batch
from ledgerlens.sources import runlog
from ledgerlens.sources.standin import scored_transactions, transactions
from ledgerlens.streaming import transactions as streams

# The named searches: a full one (50 trials of 300 rounds over three folds) takes hours and is left to search_run().
TRIALS = 2
TRIAL_ROUNDS = 20
# The grid of the logistic regression (two solvers of the grid reach the same optimum) and its folds.
GRID_C = [0.01, 0.1, 1.0, 10.0]
GRID_WEIGHTS = [5.0, 15.0, 30.0]
GRID_FOLDS = 5


# State and models that several queries of one application start from, by application, files of the table and kind.
_kept: dict[tuple, object] = {}


def _kept_as(spark: SparkSession, sf_dir: str, kind: str) -> tuple:
    """The key of a result: it names the size and time of the files, so a changed table starts anew."""
    stamps = []
    for name in ("events", "customer"):
        files = spark.read.parquet(f"{sf_dir}/{name}.parquet").select("_metadata.*")
        stamp = files.agg(F.max("file_modification_time"), F.count("*"), F.min("file_size"), F.max("file_size")).first()
        stamps.append(tuple(stamp))
    return spark.sparkContext.applicationId, sf_dir, *stamps, kind


def _derived(spark: SparkSession, sf_dir: str, extended: bool) -> Derived:
    key = _kept_as(spark, sf_dir, f"derived {extended}")
    if key not in _kept:
        _kept[key] = derive(transactions(spark, sf_dir), scratch(spark), extended=extended)
    return _kept[key]


def _prepared(spark: SparkSession, sf_dir: str, oversample: bool = True, extended: bool = False) -> Prepared:
    key = _kept_as(spark, sf_dir, f"prepared {oversample} {extended}")
    if key not in _kept:
        _kept[key] = matrices(_derived(spark, sf_dir, extended), scratch(spark), oversample)
    return _kept[key]


def _all_trained(spark: SparkSession, sf_dir: str, kinds: list[str]) -> list[models.Compared]:
    """Models of the comparison on the oversampled rows, with all their rounds, trees or iterations."""
    estimators = {
        "logistic_regression": models.logistic,
        "random_forest": models.random_forest,
        "boosted_trees": models.gbt,
        "boosted_trees_deep": lambda: models.gbt(maxDepth=7),
    }
    keys = {kind: _kept_as(spark, sf_dir, kind) for kind in kinds}
    missing = {kind: estimators[kind]() for kind in kinds if keys[kind] not in _kept}
    if missing:
        for fitted in models.fit_models(_prepared(spark, sf_dir).train, FEATURES, missing):
            _kept[keys[fitted.name]] = fitted
    return [_kept[keys[kind]] for kind in kinds]


def _trained(spark: SparkSession, sf_dir: str, kind: str = "boosted_trees") -> models.Compared:
    return _all_trained(spark, sf_dir, [kind])[0]


@query("train_gbt")
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on the oversampled training rows; metrics of the test rows."""
    prepared = _prepared(spark, sf_dir)
    return models.evaluate(prepared.test, _trained(spark, sf_dir).model)


@query("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four models on the same rows; the default booster is the one the other queries use."""
    kinds = ["boosted_trees_deep", "boosted_trees", "random_forest", "logistic_regression"]  # the longest first
    return models.compare_models(_prepared(spark, sf_dir).test, _all_trained(spark, sf_dir, kinds))


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    return models.top_features(models.importances(_trained(spark, sf_dir).model, FEATURES, prepared.test), 15)


@query("permutation_importance")
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    return models.permutation_importance(prepared.test, _trained(spark, sf_dir).model, FEATURES)


@query("trained_model_checks", TX + """
, held as (select * from tx where is_fraud is not null and substr(md5(concat(transaction_id, ':42')), 1, 8) < '33333333')
select 'test_rows' as fact, cast(count(*) as double) as "value" from held
union all select 'confusion_rows', cast(count(*) as double) from held
union all select 'confusion_positives', cast(sum(is_fraud) as double) from held
union all select 'scored_rows', cast(count(*) as double) from tx
union all select 'scores_outside_0_1', 0.0
union all select 'decisions_off_threshold', 0.0
union all select 'importance_total', 1.0
union all select 'permuted_features', 21.0
""")
def trained_model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that any trained model must meet, from the evaluation, the scored batch and both importances."""
    prepared, model = _prepared(spark, sf_dir), _trained(spark, sf_dir).model
    report = train_gbt(spark, sf_dir).first()
    batch = score_batch_query(spark, sf_dir)
    odd = batch.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("score").between(0, 1)).alias("outside"),
        F.count_if(F.col("predicted_fraud") != (F.col("score") >= DECISION_THRESHOLD).cast("int")).alias("off"),
    ).first()
    shares = models.importances(model, FEATURES, prepared.test).agg(F.round(F.sum("share"), 6)).first()[0]
    permuted = models.permutation_importance(prepared.test, model, FEATURES).count()
    facts = {
        "test_rows": prepared.test.count(),
        "confusion_rows": report["tp"] + report["fp"] + report["fn"] + report["tn"],
        "confusion_positives": report["tp"] + report["fn"],
        "scored_rows": odd["rows"],
        "scores_outside_0_1": odd["outside"],
        "decisions_off_threshold": odd["off"],
        "importance_total": shares,
        "permuted_features": permuted,
    }
    return spark.createDataFrame([(k, float(v)) for k, v in facts.items()], "fact string, value double")


@query("row_attribution")
def row_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each feature adds to the margin of every test row."""
    return attribution.attributions(_prepared(spark, sf_dir).test, _trained(spark, sf_dir).model, FEATURES)


@query("mean_attribution")
def mean_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features by the mean size of what they add, over every test row."""
    return attribution.mean_attribution(row_attribution(spark, sf_dir), FEATURES)


@query("attribution_checks", TX + """
, held as (select * from tx where is_fraud is not null and substr(md5(concat(transaction_id, ':42')), 1, 8) < '33333333')
select 'rows' as fact, cast(count(*) as double) as "value" from held
union all select 'rows_off_their_score', 0.0
union all select 'base_values', 1.0
union all select 'features', 21.0
""")
def attribution_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that attributions must meet: one row a test row, parts that add up to the model's own score, one base."""
    prepared, model = _prepared(spark, sf_dir), _trained(spark, sf_dir).model
    rows = settled(row_attribution(spark, sf_dir))
    scores = models.with_score(prepared.test, model).select("transaction_id", "score")
    total = F.col("base_value")
    for c in FEATURES:
        total = total + F.col(c)
    facts = rows.join(scores, "transaction_id").select("base_value", (F.abs(F.col("score") - 1 / (1 + F.exp(-2 * total))) > 1e-9).alias("off"))
    found = facts.agg(F.count("*"), F.count_if("off"), F.count_distinct("base_value")).first()
    named = {"rows": found[0], "rows_off_their_score": found[1], "base_values": found[2]}
    named["features"] = attribution.mean_attribution(rows, FEATURES).count()
    return spark.createDataFrame([(k, float(v)) for k, v in named.items()], "fact string, value double")


@query("feature_ablation")
def feature_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploratory list of 22 features with and without the four that add least, all rounds."""
    prepared = _prepared(spark, sf_dir, extended=True)
    return models.ablation(prepared.train, prepared.test, EXTENDED, DROPPED_LATER, models.gbt())


@query("linear_ablation")
def linear_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of the 22 features left out of a logistic regression in turn, all fits from the same passes."""
    prepared = _prepared(spark, sf_dir, oversample=False, extended=True)
    lists = {"": EXTENDED, **{c: [x for x in EXTENDED if x != c] for c in EXTENDED}, "all four": [c for c in EXTENDED if c not in DROPPED_LATER]}
    fitted = logistic.fit_all(prepared.train, [logistic.Fit(k, tuple(v), 15.0, c=1.0) for k, v in lists.items()])
    parts = [logistic.with_scores(prepared.test, f).select(F.lit(f.fit.name).alias("dropped"), models.LABEL, "score") for f in fitted]
    areas = ranking_metrics(settled(union_all(parts)), ["dropped"])
    whole = settled(areas.where("dropped = ''")).select("roc_auc").scalar()
    return areas.select("*", F.round(F.col("roc_auc") - whole, 6).alias("delta"))


@query("extended_features", TX + """
, train as (select * from tx where is_fraud is not null and substr(md5(concat(transaction_id, ':42')), 1, 8) >= '33333333')
, types as (select transaction_type, avg(sender_balance_before) as m, stddev_samp(sender_balance_before) as s from train
  where transaction_type is not null group by all)
, edges as (select list_sort(list_distinct(quantile_cont(amount, [0, .125, .25, .375, .5, .625, .75, .875, 1]))) as e from train)
select transaction_id,
 case when amount is null then -1 else least(greatest(0, len(list_filter(e, lambda x: x < amount)) - 1), greatest(0, len(e) - 2)) end as amount_band,
 round(sender_balance_after / (sender_balance_before + 1) * 100, 6) as balance_remaining_pct,
 case when sender_balance_before > m + 1.5 * s then 1 else 0 end as is_high_value_target,
 round(coalesce(sender_balance_before / (m + 1e-9), 1), 6) as bal_to_type_avg_ratio,
 round(ln(1 + amount), 6) as log_amount
from tx left join types using (transaction_type), edges
""")
def extended_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the exploratory list adds, with bands and type balances of the training rows."""
    tx = transactions(spark, sf_dir)
    train, _ = sampling.stratified_split(tx)
    derived = extended_features(tx, fit_profiles(train), fit_context(train), ["transaction_id"])
    rounded = {c: F.round(c, 6) for c in ("balance_remaining_pct", "bal_to_type_avg_ratio", "log_amount")}
    return derived.withColumns(rounded).select("transaction_id", "amount_band", "is_high_value_target", *rounded)


@query("random_search")
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few seeded trials over three folds, the positives weighted."""
    prepared = _prepared(spark, sf_dir, oversample=False)
    return models.random_search(prepared.train, FEATURES, models.random_trials(TRIALS), rounds=TRIAL_ROUNDS)


def _grid(spark: SparkSession, sf_dir: str) -> tuple[list[dict], logistic.Fitted]:
    key = _kept_as(spark, sf_dir, "grid")
    if key not in _kept:
        rows = settled(sampling.with_fold(_prepared(spark, sf_dir, oversample=False).train, GRID_FOLDS))
        _kept[key] = logistic.grid_search(rows, FEATURES, GRID_C, GRID_WEIGHTS, GRID_FOLDS)
    return _kept[key]


@query("grid_search")
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the logistic grid with its mean recall over five folds."""
    trials, _ = _grid(spark, sf_dir)
    rows = [(t["trial"], t["c"], t["positive_weight"], t["mean_recall"], t["mean_precision"]) for t in trials]
    table = spark.createDataFrame(rows, "trial int, c double, positive_weight double, mean_recall double, mean_precision double")
    return models.best_so_far(table, "trial", "mean_recall")


@query("grid_best")
def grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best cell fitted on all training rows: its parameters and its metrics on the test rows."""
    _, best = _grid(spark, sf_dir)
    scored = settled(logistic.with_scores(_prepared(spark, sf_dir, oversample=False).test, best).select(models.LABEL, "score"))
    ranks = ranking_metrics(scored).select(F.struct("*").alias("r")).scalar()
    at = threshold_sweep(scored, [0.5]).withColumn("_r", ranks).select("_r.*", "*").drop("_r")
    return at.select(F.lit(best.fit.c).alias("c"), F.lit(best.fit.positive_weight).alias("positive_weight"), "*")


@query("grid_checks", TX + """
, held as (select * from tx where is_fraud is not null and substr(md5(concat(transaction_id, ':42')), 1, 8) < '33333333')
select 'trials' as fact, 12.0::double as "value"
union all select 'recalls_outside_0_1', 0.0
union all select 'best_is_the_highest', 1.0
union all select 'test_rows', cast(count(*) as double) from held
union all select 'test_positives', cast(sum(is_fraud) as double) from held
""")
def grid_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the grid: its size, scores in range, the best cell, and the rows that its metrics count."""
    trials, best = _grid(spark, sf_dir)
    report = grid_best(spark, sf_dir).first()
    top = max(t["mean_recall"] for t in trials)
    chosen = [t["mean_recall"] for t in trials if (t["c"], t["positive_weight"]) == (best.fit.c, best.fit.positive_weight)]
    facts = {
        "trials": len(trials),
        "recalls_outside_0_1": sum(not 0 <= t["mean_recall"] <= 1 for t in trials),
        "best_is_the_highest": float(chosen == [top]),
        "test_rows": report["tp"] + report["fp"] + report["fn"] + report["tn"],
        "test_positives": report["tp"] + report["fn"],
    }
    return spark.createDataFrame([(k, float(v)) for k, v in facts.items()], "fact string, value double")


@query("score_batch")
def score_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction scored against stored state."""
    prepared = _prepared(spark, sf_dir)
    batch = transactions(spark, sf_dir).drop("is_fraud")
    return score_batch(batch, prepared.profiles, prepared.scaler, _trained(spark, sf_dir).model, "2024-01-31")


@query("run_metrics", CURVE + """
select 'evaluate' as stage, 'formula' as model, 'roc_auc' as name,
 round(sum(p*(alln - fp + n/2.0::double))/(max(allp)::double*max(alln)::double), 6) as "value" from curve
union all select 'evaluate', 'formula', 'average_precision', round(sum(p*(tp::double/(tp+fp)))/max(allp), 6) from curve
""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the formula score appended to a metric table twice; the latest of each name."""
    path = scratch(spark)
    row = settled(ranking_metrics(scored_transactions(spark, sf_dir)))
    for day in (1, 2):
        when = dt.datetime(2024, 2, day, tzinfo=dt.timezone.utc)
        runlog.append_metrics(runlog.metrics_of(row, f"run{day}", "evaluate", when, "formula"), path)
    return runlog.latest(runlog.read_metrics(spark, path)).select("stage", "model", "name", "value")


@query("resolved_params", CURVE + """
, trials as (select t.threshold, (select 2.0::double * count(*) filter (where score >= t.threshold and is_fraud = 1)
   / (count(*) filter (where score >= t.threshold) + count(*) filter (where is_fraud = 1)) from scored) as f1
  from (select unnest([0.3::double, 0.4::double, 0.5::double, 0.6::double, 0.7::double]) as threshold) t)
select 'threshold' as name, threshold as "value" from trials order by round(f1, 6) desc, threshold limit 1
""")
def resolved_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best trial of the latest of two logged searches for the threshold of the formula score, by F1 on all rows."""
    path = scratch(spark)
    scored = settled(scored_transactions(spark, sf_dir))
    for run, thresholds in ((1, [0.1, 0.9]), (2, [0.3, 0.4, 0.5, 0.6, 0.7])):
        params = F.create_map(F.lit("threshold"), F.col("threshold")).alias("params")
        trials = threshold_sweep(scored, thresholds).select(params, "f1")
        when = dt.datetime(2024, 2, run, tzinfo=dt.timezone.utc)
        runlog.append_metrics(runlog.trial_rows(trials, f"run{run}", when, "formula", "f1"), path)
    best = runlog.resolve_params(runlog.read_metrics(spark, path), {}, "f1")
    return spark.createDataFrame(sorted(best.items()), "name string, value double")


@query("metric_table")
def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC area by model and sampling of the training rows, pivoted from logged metrics."""
    path = scratch(spark)
    when = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    for stage, oversample in (("plain", False), ("oversampled", True)):
        prepared = _prepared(spark, sf_dir, oversample)
        estimators = {"logistic": models.logistic(), "forest": models.random_forest()}
        for fitted in models.fit_models(prepared.train, FEATURES, estimators):
            row = models.evaluate(prepared.test, fitted.model)
            runlog.append_metrics(runlog.metrics_of(row, stage, stage, when, fitted.name), path)
    return models.metric_table(runlog.read_metrics(spark, path), ["plain", "oversampled"])


@query("stream_velocity", TX + """
, w as (select sender_id, date_trunc('day', "timestamp") as s, count(*) as tx_count, cast(sum(is_fraud) as bigint) as fraud
 from tx group by all)
select sender_id, strftime(s, '%Y-%m-%d') as window_start, tx_count, fraud from w
where s + interval 1 day <= (select max("timestamp") from tx) - interval 1 hour
""")
def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows of each sender, streamed; every window the watermark has closed."""
    path = scratch(spark)
    stream = streams.stream_transactions(spark, sf_dir, "sender_id", "timestamp", "is_fraud")
    streams.write_appends(streams.velocity_windows(stream), f"{path}/out", f"{path}/state").awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query("stream_velocity_sliding", TX + """
, w as (select sender_id, is_fraud, unnest([time_bucket(interval 12 hours, "timestamp"),
  time_bucket(interval 12 hours, "timestamp") - interval 12 hours]) as s from tx)
select sender_id, strftime(s, '%Y-%m-%d %H:%M') as window_start, count(*) as tx_count, cast(sum(is_fraud) as bigint) as fraud
from w where s + interval 1 day <= (select max("timestamp") from tx) - interval 1 hour group by all
""")
def stream_velocity_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a day every twelve hours."""
    path = scratch(spark)
    stream = streams.stream_transactions(spark, sf_dir, "sender_id", "timestamp", "is_fraud")
    sliding = streams.velocity_windows(stream, "1 day", "12 hours")
    streams.write_appends(sliding, f"{path}/out", f"{path}/state").awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("stream_sessions", TX + """
, marked as (select sender_id, "timestamp" as t, case when "timestamp" < lag("timestamp") over (partition by sender_id
  order by "timestamp") + interval 6 hours then 0 else 1 end as opens from tx)
, numbered as (select *, sum(opens) over (partition by sender_id order by t rows unbounded preceding) as s from marked)
, closed as (select sender_id, min(t) as a, max(t) + interval 6 hours as b, count(*) as tx_count from numbered
  group by sender_id, s)
select sender_id, strftime(a, '%Y-%m-%d %H:%M:%S') as session_start, strftime(b, '%Y-%m-%d %H:%M:%S') as session_end,
 tx_count from closed where b <= (select max("timestamp") from tx) - interval 1 hour
""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sender's sessions, closed by six hours without a row."""
    path = scratch(spark)
    stream = streams.stream_transactions(spark, sf_dir, "sender_id", "timestamp")
    sessions = streams.session_windows(stream, "6 hours")
    streams.write_appends(sessions, f"{path}/out", f"{path}/state").awaitTermination()
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("session_start", "session_end")}
    return spark.read.parquet(f"{path}/out").withColumns(shown)


@query("stream_profiles", TX + profiles_sql("tx") + """
select sender_id, total_tx, unique_recv, unique_devices, round(avg_amount, 4) as avg_amount, primary_device from sp
""")
def stream_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles kept by a stream equal the profiles of the whole table."""
    path = scratch(spark)
    stream = streams.stream_transactions(
        spark, sf_dir, "transaction_id", "sender_id", "receiver_id", "device_id", "amount"
    )
    streams.maintain_profiles(stream, f"{path}/pairs", f"{path}/state").awaitTermination()
    sender, _ = streams.maintained_profiles(spark, f"{path}/pairs")
    return sender.withColumn("avg_amount", F.round("avg_amount", 4))


@query("stream_scores")
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of all transactions scored against stored state."""
    prepared = _prepared(spark, sf_dir)
    path = scratch(spark)
    stream = streams.stream_transactions(spark, sf_dir)
    scored = streams.score_stream(
        stream, prepared.profiles, prepared.scaler, _trained(spark, sf_dir).model, ["transaction_id"], 0.33
    )
    streams.write_appends(scored, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out")
