"""The physical plans: no Python rows, no raw rows in one task, columns and filters pushed down."""

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profiles, rates, summaries
from ledgerlens.operators.features import features
from ledgerlens.operators.ordered import exact_quantiles
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.sources.standin import transactions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_auto_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize(
    "name",
    [
        "fraud_rate_by_type", "pivot_dow_hour", "sender_profile", "features_unscaled", "scaled_features", "quarantine",
        "account_age", "histogram", "roc_points", "threshold_sweep", "high_value_target", "describe_numeric",
        "stratified_split", "cv_folds",
    ],
)
def test_no_python_and_no_cross_joins(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_windows_never_see_raw_rows_in_one_partition(spark, data):
    """A single-partition exchange carries an aggregate, never rows."""
    for name in ("roc_points", "cumulative_by_date", "fraud_rate_by_type", "account_age", "histogram"):
        lines = plan_of(QUERIES[name](spark, data)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = "".join(lines[i + 1 : i + 5])
                assert "Aggregate" in below, (name, below)


def test_a_rate_reads_only_its_columns(spark, data):
    tx = transactions(spark, data, "transaction_type", "is_fraud")
    plan = plan_of(rates.rate_by(tx, "transaction_type"))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [
        "event_id:bigint,ts:timestamp_ntz,event_type:string,value:double"
    ]
    assert "customer.parquet" not in plan


def test_filters_reach_the_scan(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").where("value > 150").select("event_id")
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,150.0)]" in plan_of(events)


def test_profile_aggregates_before_the_shuffle(spark, tx):
    plan = plan_of(profiles.device_pairs(tx))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")


def test_large_profiles_are_not_broadcast(spark, data, no_auto_broadcast):
    """Without room to broadcast, the features use shuffled joins and give the same rows."""
    tx = transactions(spark, data)
    fitted = profiles.fit_profiles(tx)
    narrow = features(tx, fitted, ["transaction_id"])
    assert not re.search(r"BroadcastHashJoin \[(sender|device)_id", plan_of(narrow))
    assert re.search(r"SortMergeJoin \[sender_id", plan_of(narrow))
    rows = sorted(map(str, narrow.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    wide = features(tx, fitted, ["transaction_id"])
    assert re.search(r"BroadcastHashJoin \[sender_id", plan_of(wide))
    assert sorted(map(str, wide.collect())) == rows


def test_small_tables_over_the_limit_are_joined_by_shuffle(spark, tx, monkeypatch, no_auto_broadcast):
    from ledgerlens.operators import small

    hinted = summaries.with_type_balance(tx)
    assert "BroadcastHashJoin [transaction_type" in plan_of(hinted)
    expected = sorted(map(str, hinted.collect()))
    quantiles = sorted(map(str, exact_quantiles(tx, ["amount"], [0.1, 0.9], ["transaction_type"], buckets=64).collect()))
    monkeypatch.setattr(small.bounded, "__defaults__", (0,))
    got = summaries.with_type_balance(tx)
    assert "BroadcastHashJoin [transaction_type" not in plan_of(got)
    assert sorted(map(str, got.collect())) == expected
    again = exact_quantiles(tx, ["amount"], [0.1, 0.9], ["transaction_type"], buckets=64)
    assert sorted(map(str, again.collect())) == quantiles


def test_a_hot_sender_gives_the_same_features(spark, tx):
    """A third and more of all rows from one sender."""
    hot = tx.withColumn("sender_id", F.when(F.col("transaction_id").cast("int") % 2 == 0, "S1").otherwise(F.col("sender_id")))
    fitted = profiles.fit_profiles(hot)
    total = features(hot, fitted, ["sender_id"]).where("sender_id = 'S1'").agg(F.max("sender_total_tx"), F.count("*")).first()
    assert total[0] == total[1] > tx.count() / 3


def test_library_text_is_clean():
    """No data-sized collects and nothing tied to one machine in the library."""
    for folder, _, names in os.walk(os.path.join(ROOT, "ledgerlens")):
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name)).read()
                for unwanted in ("localCheckpoint", "crossJoin", ".rdd", "coalesce(1)"):
                    assert unwanted not in text, (name, unwanted)


def test_overview_reads_its_table_once(spark, data, tmp_path):
    transactions(spark, data).write.parquet(str(tmp_path / "tx"))
    plan = plan_of(summaries.dataset_overview(spark.read.parquet(str(tmp_path / "tx"))))
    assert plan.count("FileScan parquet") == 1


def test_overview_of_an_empty_table_and_sketched_counts(spark, data):
    tx = transactions(spark, data)
    empty = {r["item"]: r["value"] for r in summaries.dataset_overview(tx.limit(0)).collect()}
    assert empty["rows"] == "0" and empty["senders"] == "0" and empty["first_time"] is None and empty["fraud"] is None
    exact, sketched = ([tuple(r)[0] for r in summaries.dataset_overview(tx, flag).collect()] for flag in (False, True))
    assert exact == sketched
