"""Readers, writers, guards and stored state."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profiles
from ledgerlens.operators.scaling import fit_scaler
from ledgerlens.sources import files, runlog, state
from ledgerlens.sources.contract import SCORING_COLUMNS, declared_schema


def test_csv_with_an_unreadable_row(spark, tmp_path):
    header = ",".join(f.name for f in declared_schema().fields)
    good = "t1,2024-01-01 00:00:00,s,r,1.5,deposit,1,2,3,4,007,0,36,0"
    bad = good.replace("1.5", "many")
    (tmp_path / "a.csv").write_text("\n".join([header, good, bad]) + "\n")
    table = files.read_csv(spark, str(tmp_path / "a.csv"), declared_schema(), keep_corrupt=True).cache()
    rows = {r["amount"]: r for r in table.collect()}
    assert rows[1.5]["device_id"] == "007" and rows[1.5][files.CORRUPT] is None
    assert rows[None][files.CORRUPT] == bad


def test_json_lines_and_one_array(spark, tmp_path):
    records = [{"transaction_id": "1", "amount": 2.0}, {"transaction_id": "2", "amount": None}]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    schema = declared_schema(label=False)
    lines = files.read_json(spark, str(tmp_path / "lines.json"), schema)
    array = files.read_json(spark, str(tmp_path / "array.json"), schema, one_array=True)
    assert lines.columns == SCORING_COLUMNS
    assert sorted(map(str, lines.collect())) == sorted(map(str, array.collect()))


def test_guards(spark, tmp_path):
    with pytest.raises(files.SourceError, match="no such source"):
        files.read_parquet(spark, str(tmp_path / "nothing"))
    df = spark.createDataFrame([(1,)], "amount int")
    with pytest.raises(files.SourceError, match="no rows"):
        files.require_rows(df.where("amount > 1"))
    with pytest.raises(files.SourceError, match="device_id"):
        files.require_columns(df, ["amount", "device_id"])
    assert files.require_rows(df) is df and files.require_columns(df, ["amount"]) is df


def test_projection_reads_one_column(spark, tx, tmp_path):
    path = files.write_parquet(tx, str(tmp_path / "tx"))
    plan = files.read_parquet(spark, path, ["is_fraud"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<is_fraud:int>" in plan


def test_csv_sink_is_a_folder_with_headers(spark, tmp_path):
    df = spark.range(10, numPartitions=3).select(F.col("id").alias("n"))
    path = files.write_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(path).count() == 10


def test_profiles_and_scaler_come_back(spark, tx, tmp_path):
    stored = state.fit_and_save_profiles(tx, str(tmp_path / "p"))
    direct = profiles.fit_profiles(tx)
    for name in ("sender", "device", "fallbacks"):
        one, two = getattr(stored, name), getattr(direct, name)
        shown = [F.round(c, 6).alias(c) if t == "double" else c for c, t in two.dtypes]
        assert sorted(map(str, one.select(shown).collect())) == sorted(map(str, two.select(shown).collect()))
    scaler = fit_scaler(tx, ["amount", "location_lat"])
    state.save_scaler(scaler, str(tmp_path / "s"))
    loaded = state.load_scaler(spark, str(tmp_path / "s"))
    assert sorted(map(str, loaded.table().collect())) == sorted(map(str, scaler.table().collect()))
    assert state.load_table(spark, str(tmp_path / "none")) is None


def test_run_log_and_parameter_choice(spark, tmp_path):
    path, default = str(tmp_path / "log"), {"rounds": 200}
    assert runlog.resolve_params(None, default) == default
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    for run, when, value, params in [
        ("a", old, 0.99, {"rounds": 1}),
        ("b", new, 0.80, {"rounds": 2}),
        ("b", new, 0.90, {"rounds": 3}),
    ]:
        rows = runlog.metric_rows(spark, run, "search", {"mean_roc_auc": value}, params=json.dumps(params), ts=when)
        runlog.append_metrics(rows, path)
    log = runlog.read_metrics(spark, path)
    assert log.count() == 3
    # the best trial of the latest run
    assert runlog.resolve_params(log, default) == {"rounds": 3}
    other = runlog.metric_rows(spark, "c", "evaluate", {"x": 1.0}, ts=new)
    assert runlog.resolve_params(other, default) == default


def test_export_gate(spark):
    for value, expected in [(0.95, True), (0.9499, False)]:
        row = spark.createDataFrame([(value,)], "roc_auc double")
        assert state.export_gate(row).first()["may_export"] is expected
