"""Whole runs, samples and splits, and streams against their batch answers."""

import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerlens.operators import models, sampling
from ledgerlens.operators.features import FEATURES
from ledgerlens.plans import model_queries, runs
from ledgerlens.plans.quality_queries import contract_table
from ledgerlens.plans.runs import prepare, score_batch, scoring_run, submission, training_run
from ledgerlens.sources import runlog, state
from ledgerlens.sources.standin import transactions, transactions_from
from ledgerlens.streaming import transactions as streams


@pytest.fixture(scope="module")
def root(spark, data, tmp_path_factory):
    """A finished training run. Rows that break the contract are set aside first."""
    folder = str(tmp_path_factory.mktemp("run"))
    raw = contract_table(spark, data).where("sender_balance_after >= -1584")
    report = training_run(raw, folder, "run1", models.gbt(5))
    assert {r["metric"] for r in report.collect()} >= {"roc_auc", "average_precision", "recall"}
    return folder


def _state(spark, root):
    return (
        state.load_profiles(spark, f"{root}/profiles"),
        state.load_scaler(spark, f"{root}/scaler"),
        PipelineModel.load(f"{root}/model"),
    )


def test_training_run_leaves_its_parts(spark, root):
    train = spark.read.parquet(f"{root}/matrix/train")
    counts = {r["is_fraud"]: r["count"] for r in train.groupBy("is_fraud").count().collect()}
    assert counts[0] == counts[1]
    assert set(FEATURES) < set(train.columns)
    log = runlog.read_metrics(spark, f"{root}/run_metrics")
    assert log.where("stage = 'evaluate' and name = 'roc_auc'").count() == 1
    assert spark.read.parquet(f"{root}/baseline").where("kind = 'bin'").count() > 0


def test_profiles_are_fitted_on_training_rows(spark, root):
    rows = spark.read.parquet(f"{root}/validated")
    train, _ = sampling.stratified_split(rows)
    total = spark.read.parquet(f"{root}/profiles/sender").agg(F.sum("total_tx")).first()[0]
    assert total == train.count() < rows.count()


def test_scoring_run(spark, data, root, tmp_path):
    batch = contract_table(spark, data).drop("is_fraud")
    scored = scoring_run(batch, root, str(tmp_path / "out"), "2024-02-01")
    assert scored.count() == batch.count()
    assert scored.columns == [
        "transaction_id", "timestamp", "sender_id", "receiver_id", "amount", "transaction_type", "score",
        "predicted_fraud", "batch_date",
    ]
    csv = spark.read.option("header", True).csv(str(tmp_path / "out/predictions"))
    assert csv.count() == batch.count() and "fraud_score" in csv.columns
    assert spark.read.json(str(tmp_path / "out/monitoring")).where("column = '*'").count() == 1
    assert submission(scored).columns == ["transaction_id", "predicted_fraud"]


def test_a_score_does_not_depend_on_the_batch(spark, data, root):
    batch = contract_table(spark, data).drop("is_fraud")
    parts = _state(spark, root)
    whole = score_batch(batch, *parts, "d").where("sender_id = 'S1'")
    alone = score_batch(batch.where("sender_id = 'S1'"), *parts, "d")
    assert sorted(map(str, whole.collect())) == sorted(map(str, alone.collect()))


def test_export_refuses_and_writes(spark, root, tmp_path):
    _, scaler, model = _state(spark, root)
    row = spark.createDataFrame([(0.5, 0.4)], "roc_auc double, average_precision double")
    with pytest.raises(ValueError, match="below the export minimum"):
        state.export_model(model, f"{root}/profiles", scaler, row, str(tmp_path), "1")
    path = state.export_model(model, f"{root}/profiles", scaler, row, str(tmp_path), "1", minimum=0.4)
    assert PipelineModel.load(f"{path}/model").stages[-1].getNumTrees == 5
    assert spark.read.json(f"{path}/metadata").first()["model_version"] == "1"


def test_streamed_scores_equal_batch_scores(spark, data, root, tmp_path):
    parts = _state(spark, root)
    stream = streams.stream_transactions(spark, data)
    scored = streams.score_stream(stream, *parts, ["transaction_id"], 0.33)
    streams.write_appends(scored, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = score_batch(transactions(spark, data), *parts, "d").select("transaction_id", "score", "predicted_fraud")
    streamed = spark.read.parquet(str(tmp_path / "out")).select("transaction_id", "score", "predicted_fraud")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def _event_files(spark, data, folder):
    """The events as three files, by time."""
    events = spark.read.parquet(f"{data}/events.parquet")
    cuts = ["2024-01-11", "2024-01-21", "2024-02-01"]
    previous = "2024-01-01"
    for i, cut in enumerate(cuts):
        part = events.where((F.col("ts") >= F.lit(previous).cast("timestamp_ntz")) & (F.col("ts") < F.lit(cut).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/part{i}")
        previous = cut
    return events


def test_profiles_from_many_batches_equal_the_whole(spark, data, tmp_path):
    from ledgerlens.operators.profiles import sender_and_device

    events = _event_files(spark, data, tmp_path / "in")
    customer = spark.read.parquet(f"{data}/customer.parquet")
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/part*")
    )
    names = ["transaction_id", "sender_id", "receiver_id", "device_id", "amount"]
    running = streams.maintain_profiles(
        transactions_from(stream, customer, *names), str(tmp_path / "pairs"), str(tmp_path / "state")
    )
    running.awaitTermination()
    assert running.lastProgress["batchId"] >= 2
    streamed = streams.maintained_profiles(spark, str(tmp_path / "pairs"))
    whole = sender_and_device(transactions(spark, data, *names))
    for one, two in zip(streamed, whole):
        shown = [F.round(c, 6).alias(c) if t == "double" else c for c, t in two.dtypes]
        assert sorted(map(str, one.select(shown).collect())) == sorted(map(str, two.select(shown).collect()))


def test_parts_of_profiles_are_merged_by_level_and_survive_crashes(spark, tx, tmp_path, monkeypatch):
    from ledgerlens.operators.profiles import sender_and_device

    names = ["transaction_id", "sender_id", "receiver_id", "device_id", "amount"]
    tx = tx.select(*names, (F.crc32("transaction_id") % 9).alias("n")).cache()
    path = str(tmp_path / "pairs")

    def shown(profiles):
        rounded = [p.select([F.round(c, 6).alias(c) if t == "double" else c for c, t in p.dtypes]) for p in profiles]
        return [sorted(map(str, p.collect())) for p in rounded]

    def whole(batches):
        return shown(sender_and_device(tx.where(F.col("n") < batches)))

    def broken(parts):
        raise RuntimeError("executor lost")

    with pytest.raises(FileNotFoundError):
        streams.maintained_profiles(spark, path)
    make, merge = streams.PAIR_TABLES["receiver_pairs"]
    for number in range(9):
        batch = tx.where(F.col("n") == number)
        if number == 7:  # ends in the midst of the merges, and is run again
            monkeypatch.setitem(streams.PAIR_TABLES, "receiver_pairs", (make, broken))
            with pytest.raises(RuntimeError):
                streams.fold_batch(batch, number, path)
            monkeypatch.setitem(streams.PAIR_TABLES, "receiver_pairs", (make, merge))
            assert shown(streams.maintained_profiles(spark, path)) == whole(7)
        streams.fold_batch(batch, number, path)
        known = streams._manifests(spark, path)
        assert len(known) == min(2, number + 1)
        assert len(known[number]) == (number + 1).bit_count()
    assert known[8] == [(3, 0, 7), (0, 8, 8)]
    assert {f.name for f in (tmp_path / "pairs/device_pairs").iterdir()} == {"3-0-7", "0-8-8"}
    assert shown(streams.maintained_profiles(spark, path)) == whole(9)
    streams.fold_batch(tx.where("n = 8"), 8, path)
    assert shown(streams.maintained_profiles(spark, path)) == whole(9)


def test_late_rows_are_dropped_and_sessions_close(spark, tmp_path):
    schema = "sender_id string, timestamp timestamp_ntz, is_fraud int"
    batches = [
        [("s", "2024-01-01 10:00:00", 0), ("s", "2024-01-01 10:10:00", 1), ("s", "2024-01-03 00:00:00", 0)],
        [("s", "2024-01-05 00:00:00", 0)],
        [("s", "2024-01-01 11:00:00", 0), ("s", "2024-01-07 00:00:00", 0)],
    ]
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "sender_id string, t string, is_fraud int")
        frame = frame.select("sender_id", F.col("t").cast("timestamp_ntz").alias("timestamp"), "is_fraud")
        frame.coalesce(1).write.parquet(f"{folder}/b{i}")

    def source():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")

    daily = streams.velocity_windows(source(), "1 day", lateness="1 hour")
    streams.write_appends(daily, str(tmp_path / "daily"), str(tmp_path / "s1")).awaitTermination()
    got = {r["d"]: r["tx_count"] for r in spark.read.parquet(str(tmp_path / "daily")).select(
        F.date_format("window_start", "MM-dd").alias("d"), "tx_count").collect()}
    # 11:00 on the first arrives after its window was closed: dropped
    assert got == {"01-01": 2, "01-03": 1, "01-05": 1}
    sessions = streams.session_windows(source(), "30 minutes", "1 hour")
    streams.write_appends(sessions, str(tmp_path / "sessions"), str(tmp_path / "s2")).awaitTermination()
    counts = sorted(r["tx_count"] for r in spark.read.parquet(str(tmp_path / "sessions")).collect())
    assert counts == [1, 1, 2]


def test_split_is_a_partition(tx):
    for split in (sampling.stratified_split, sampling.exact_stratified_split):
        train, test = split(tx.select("transaction_id", "is_fraud"))
        assert train.count() + test.count() == tx.count()
        assert train.join(test, "transaction_id").count() == 0


def test_exact_split_sizes(tx):
    _, test = sampling.exact_stratified_split(tx.select("transaction_id", "is_fraud"), 0.2)
    sizes = {r["is_fraud"]: r["count"] for r in tx.groupBy("is_fraud").count().collect()}
    got = {r["is_fraud"]: r["count"] for r in test.groupBy("is_fraud").count().collect()}
    assert got == {k: round(n * 0.2) for k, n in sizes.items()}


def test_samples_do_not_depend_on_layout(tx):
    one = {r[0] for r in sampling.hash_sample(tx, 0.3).select("transaction_id").collect()}
    two = {r[0] for r in sampling.hash_sample(tx.repartition(9), 0.3).select("transaction_id").collect()}
    assert one == two
    assert sampling.hash_sample(tx, 1.0).count() == tx.count()
    assert sampling.sample_rows(tx, 10).count() == 10


def test_folds_keep_class_shares(tx):
    folds = sampling.with_fold(tx, 3).groupBy("fold").agg(F.avg("is_fraud").alias("rate"), F.count("*").alias("n")).collect()
    assert len(folds) == 3 and sum(r["n"] for r in folds) == tx.count()


def test_trials_are_seeded_and_in_range():
    one, two = models.random_trials(20), models.random_trials(20)
    assert one == two and one != models.random_trials(20, seed=1)
    for params in one:
        for name, (low, high, _) in models.SEARCH_SPACE.items():
            assert low <= params[name] <= high


def test_permutation_importance_finds_the_only_signal(spark):
    df = spark.range(400).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 2).cast("int").alias("is_fraud"),
        ((F.col("id") % 2) * 2 + F.rand(1)).alias("signal"),
        F.rand(2).alias("noise"),
    )
    model = models.train(df, ["signal", "noise"], models.logistic(50))
    got = {r["feature"]: r for r in models.permutation_importance(df, model, ["signal", "noise"]).collect()}
    assert got["signal"]["drop"] > 0.3 and abs(got["noise"]["drop"]) < 0.05


def test_permuted_rows_are_scored_in_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 2).cast("int").alias("is_fraud"),
        ((F.col("id") % 2) + F.rand(1)).alias("signal"),
        F.rand(2).alias("noise"),
    )
    model = models.train(df, ["signal", "noise"], models.logistic(50))
    whole = sorted(map(str, models.permutation_importance(df, model, ["signal", "noise"]).collect()))
    parts, score = [], models.with_score
    monkeypatch.setattr(models, "with_score", lambda rows, m: parts.append(rows.rdd.getNumPartitions()) or score(rows, m))
    monkeypatch.setattr(models, "SCORED_ROWS", 100)
    assert sorted(map(str, models.permutation_importance(df, model, ["signal", "noise"]).collect())) == whole
    assert parts == [9]


def test_models_over_few_rows_are_fitted_side_by_side(spark, monkeypatch):
    """Two fits wait for each other, so one after the other would break the barrier; many rows are fitted in turn."""
    df = spark.range(60).select((F.col("id") % 2).cast("int").alias("is_fraud"), (F.col("id") % 7).cast("double").alias("x"))
    met, train = threading.Barrier(2, timeout=60), models.train
    monkeypatch.setattr(models, "train", lambda *given: met.wait() in (0, 1) and train(*given))
    fitted = models.fit_models(df, ["x"], {"b": models.gbt(2), "a": models.logistic(5)})
    assert [m.name for m in fitted] == ["b", "a"] and fitted[0].model.stages[-1].getNumTrees == 2
    held = df.withColumn("y", F.col("x") * 2)
    assert models.ablation(held, held, ["x", "y"], ["y"], models.gbt(2)).count() == 6
    monkeypatch.setattr(models, "FITS_ROWS", 59)
    assert models.fits_at_once(df) == 1


def test_plain_and_oversampled_matrices_share_their_features(spark, data, monkeypatch):
    """The features are derived once, and both pairs of matrices are those of a preparation of their own."""
    derived, derive = [], model_queries.derive
    monkeypatch.setattr(model_queries, "derive", lambda *given, **named: derived.append(1) or derive(*given, **named))
    monkeypatch.setattr(model_queries, "_kept", {})
    tx = transactions(spark, data)
    for oversample in (False, True):
        shared = model_queries._prepared(spark, data, oversample)
        alone = prepare(tx, model_queries.scratch(spark), oversample=oversample)
        for one, two in ((shared.train, alone.train), (shared.test, alone.test)):
            assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert len(derived) == 1


def test_a_matrix_of_several_files_fills_every_core(spark, data, monkeypatch):
    assert [runs.matrix_files(n, 8) for n in (0, 250_000, 250_001, 960_000, 9_600_000)] == [1, 1, 8, 8, 40]
    derived = runs.derive(transactions(spark, data), model_queries.scratch(spark))
    monkeypatch.setattr(runs, "MATRIX_ROWS", 300)
    prepared = runs.matrices(derived, model_queries.scratch(spark))
    cores = spark.sparkContext.defaultParallelism
    assert len(prepared.train.inputFiles()) % cores == 0
    assert prepared.train.where("is_synthetic = 0").count() == derived.train.count()
