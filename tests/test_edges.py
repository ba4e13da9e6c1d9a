"""Hand-made frames, one for each trap, with results worked out by hand."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import geo, labels, money, temporal
from ledgerlens.functions.numeric import clipped, rounded
from ledgerlens.operators import cleaning, drift, metrics, ordered, profiles, rates, scaling, validation
from ledgerlens.operators.features import features
from ledgerlens.sources.contract import TRANSACTION_RULES
from ledgerlens.sources.files import SourceError

NAN, INF = float("nan"), float("inf")


def test_nonfinite_becomes_null(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, NAN, NAN, None, INF, -INF]], "x double")
    mended = cleaning.null_nonfinite(df)
    assert mended.agg(F.countDistinct("x")).first()[0] == 1
    assert cleaning.drop_null_rows(mended).count() == 1


def test_constant_columns(spark):
    rows = [("KES", None, 1.0, 5.0, "a"), ("KES", None, 1.0, 6.0, None)]
    df = spark.createDataFrame(rows, "currency string, empty string, amount double, x double, y string")
    found = {r["column"]: r for r in cleaning.column_constancy(df).collect()}
    assert found["currency"]["is_constant"] == 1 and found["empty"]["is_constant"] == 0
    assert found["empty"]["is_all_null"] == 1 and found["y"]["is_constant"] == 1
    assert found["amount"]["is_zero_variance"] == 1 and found["currency"]["is_zero_variance"] == 0
    # a contract column stays although it is constant, unless asked otherwise
    assert cleaning.drop_constant_columns(df).columns == ["empty", "amount", "x"]
    assert cleaning.drop_constant_columns(df, keep=()).columns == ["empty", "x"]
    with pytest.raises(SourceError, match="empty"):
        cleaning.clean(df)


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "transaction_id string, x int")
    assert cleaning.drop_duplicates(df).count() == 3
    assert cleaning.duplicate_keys(df, "transaction_id").first().asDict() == {
        "row_count": 4,
        "distinct_keys": 2,
        "duplicates": 2,
    }


def _tx(spark, rows):
    names = [r.column for r in TRANSACTION_RULES]
    kinds = {"string": "string", "float": "double", "integer": "int"}
    schema = ", ".join(f"{r.column} {kinds[r.kind]}" for r in TRANSACTION_RULES)
    good = dict(
        transaction_id="t", timestamp="2024-01-06 03:00:00", sender_id="s1", receiver_id="r1", amount=10.0,
        transaction_type="deposit", sender_balance_before=100.0, sender_balance_after=90.0,
        receiver_balance_before=0.0, receiver_balance_after=10.0, device_id="d1", location_lat=0.0, location_lon=36.0,
        is_fraud=0,
    )
    full = [{**good, "transaction_id": f"t{i}", **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)


def test_domain_rules_are_strict(spark):
    df = _tx(
        spark,
        [
            {"amount": -0.01},
            {"amount": 0.0, "sender_balance_after": -1584.0},
            {"location_lat": 90.0},
            {"location_lat": 90.01},
            {"transaction_type": "airtime"},
            {"is_fraud": 2},
            {"sender_balance_after": None},
        ],
    )
    broken = {(r["column"], r["rule"]): r["violations"] for r in validation.range_violations(df).collect()}
    assert broken[("amount", "minimum")] == 1 and broken[("location_lat", "maximum")] == 1
    assert sum(broken.values()) == 2
    outside = {(r["column"], r["value"], r["rows"]) for r in validation.enum_violations(df).collect()}
    assert outside == {("transaction_type", "airtime", 1), ("is_fraud", "2", 1)}
    good, bad = validation.quarantine(df)
    assert good.count() == 3
    assert {r["transaction_id"]: r["violations"] for r in bad.collect()} == {
        "t0": ["amount:minimum"],
        "t3": ["location_lat:maximum"],
        "t4": ["transaction_type:enum"],
        "t5": ["is_fraud:enum"],
    }


def test_validation_writes_only_what_passes(spark, tmp_path):
    good = _tx(spark, [{}, {"is_fraud": 1}])
    status = validation.validate(good, str(tmp_path / "ok"))
    assert status.where(~F.col("passed")).count() == 0
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 2
    with pytest.raises(validation.ValidationError, match="amount minimum: 1 rows"):
        validation.validate(_tx(spark, [{}, {"amount": -5.0}]), str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
    with pytest.raises(validation.ValidationError, match="missing columns"):
        validation.validate(good.drop("amount"), str(tmp_path / "bad"))
    with pytest.raises(validation.ValidationError, match="rows"):
        validation.validate(good.where("amount < 0"), str(tmp_path / "bad"))


def test_schema_findings(spark):
    df = _tx(spark, [{}]).withColumn("amount", F.lit("10")).withColumn("extra", F.lit(1)).drop("device_id")
    found = validation.check_schema(df)
    assert (found.missing, found.unexpected, found.mismatched) == (["device_id"], ["extra"], ["amount"])
    assert not found.passed
    assert validation.check_schema(_tx(spark, [{}]).withColumn("extra", F.lit(1))).passed


def test_primary_device_tie_goes_to_the_lowest(spark):
    rows = [{"sender_id": "s1", "device_id": d} for d in ["D2", "D1", "D2", "D1"]] + [{"sender_id": "s2", "device_id": "D9"}]
    sender, device = profiles.sender_and_device(_tx(spark, rows))
    got = {r["sender_id"]: r for r in sender.collect()}
    assert got["s1"]["primary_device"] == "D1" and got["s1"]["unique_devices"] == 2 and got["s1"]["total_tx"] == 4
    assert {r["device_id"]: r["unique_senders"] for r in device.collect()} == {"D1": 1, "D2": 1, "D9": 1}


def test_unseen_entities_get_fallbacks(spark):
    known = _tx(
        spark,
        [
            {"sender_id": "s1", "device_id": "d1", "amount": 9.0},
            {"sender_id": "s1", "device_id": "d1", "amount": 9.0},
            {"sender_id": "s2", "device_id": "d1", "amount": 99.0, "receiver_id": "r2"},
        ],
    )
    fitted = profiles.fit_profiles(known)
    fallback = fitted.fallbacks.first()
    # medians over senders: 1.5 rows is cut to 1, the mean amounts 9 and 99 give 54
    assert (fallback["total_tx"], fallback["unique_recv"], fallback["avg_amount"]) == (1, 1, 54.0)
    new = _tx(
        spark,
        [
            {"sender_id": "s9", "device_id": "d1", "amount": 110.0},
            {"sender_id": "s1", "device_id": "d7", "amount": 10.0},
            {"sender_id": "s1", "device_id": "d1", "amount": 10.0},
        ],
    )
    got = {r["transaction_id"]: r for r in features(new, fitted, ["transaction_id"]).collect()}
    unseen, other_device, known_device = got["t0"], got["t1"], got["t2"]
    assert (unseen["is_device_switch"], unseen["sender_total_tx"], unseen["amount_vs_sender_avg"]) == (0, 1, 2.0)
    assert unseen["device_unique_senders"] == 2
    assert (other_device["is_device_switch"], other_device["device_unique_senders"]) == (1, 1)
    assert (known_device["is_device_switch"], known_device["amount_vs_sender_avg"]) == (0, 1.0)
    assert (unseen["hour"], unseen["day_of_week"], unseen["is_night"], unseen["is_weekend"]) == (3, 5, 1, 1)


def test_refresh_keeps_fallbacks(spark, tx):
    fitted = profiles.fit_profiles(tx)
    fresh = profiles.refresh_profiles(fitted, tx, "2024-01-31 00:00:00")
    assert fresh.fallbacks is fitted.fallbacks
    assert sorted(map(str, fresh.sender.collect())) == sorted(map(str, fitted.sender.collect()))
    assert profiles.refresh_profiles(fitted, tx, "2025-01-01 00:00:00").sender.count() == 0


def test_half_degrees_go_to_even(spark):
    df = spark.createDataFrame([(v, v) for v in [0.5, 1.5, 2.5, -0.4]], "location_lat double, location_lon double")
    got = [r["grid_lat"] for r in df.select(*[c.alias(n) for n, c in geo.grid_cell().items()]).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0]
    assert all(math.copysign(1, v) == 1 for v in got)


def test_age_buckets_are_right_closed(spark):
    days = [0, 1, 7, 8, 30, 31, 90, 91, 180, 181, None]
    df = spark.createDataFrame([(d,) for d in days], "d int").select(labels.age_bucket(F.col("d")).alias("b"))
    names = labels.AGE_LABELS
    expected = [names[i] for i in [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]] + [None]
    assert [r["b"] for r in df.collect()] == expected


def test_whole_days_and_unreadable_times(spark):
    df = spark.createDataFrame([("2024-01-01 12:00:00", "2024-01-03 11:59:59"), ("never", None)], "a string, b string")
    got = df.select(
        temporal.whole_days(temporal.event_time(F.col("b")), temporal.event_time(F.col("a"))).alias("d"),
        temporal.event_time(F.col("a")).alias("a"),
    ).collect()
    assert [r["d"] for r in got] == [1, None]
    assert got[0]["a"] == dt.datetime(2024, 1, 1, 12) and got[1]["a"] is None


def test_small_functions(spark):
    row = spark.range(1).select(
        money.type_code(F.lit("deposit")).alias("deposit"),
        money.type_code(F.lit("airtime")).alias("unknown"),
        clipped(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0)).alias("clip_null"),
        clipped(F.lit(1.7), F.lit(0.0), F.lit(1.0)).alias("clip_high"),
        labels.range_label(F.lit(1234.9), F.lit(5678.0)).alias("range"),
        labels.risk_tier(F.lit(0.55)).alias("high"),
        labels.risk_tier(F.lit(0.30)).alias("middle"),
        labels.risk_tier(F.lit(0.29)).alias("low"),
        labels.predicted_fraud(F.lit(0.33)).alias("flag"),
        rounded(F.lit(-0.0000001)).alias("zero"),
        geo.distance_km(F.lit(-1.2921), F.lit(36.8219)).alias("at_home"),
        geo.distance_km(F.lit(-1.2921), F.lit(37.8219)).alias("one_degree_east"),
    ).first()
    assert (row["deposit"], row["unknown"], row["clip_null"], row["clip_high"]) == (4, -1, None, 1.0)
    assert (row["range"], row["high"], row["middle"], row["low"]) == ("1,234-5,678", "fraud", "suspicious", "legitimate")
    assert row["flag"] == 1 and math.copysign(1, row["zero"]) == 1
    assert row["at_home"] == 0.0 and row["one_degree_east"] == pytest.approx(111.166, abs=0.01)


def test_scaler_uses_population_spread(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, flat double")
    got = scaling.apply_scaler(df, scaling.fit_scaler(df, ["x", "flat"])).collect()
    assert sorted(r["x"] for r in got) == [-1.0, 1.0] and {r["flat"] for r in got} == {0.0}


def test_numeric_stability_by_hand(spark):
    reference = spark.createDataFrame([(float(v),) for v in range(11)], "amount double")
    moments = drift.numeric_moments(reference, ["amount"])
    counts = {r["bin"]: r["n"] for r in drift.bin_counts(reference, moments, ["amount"]).collect()}
    # 0..10 in steps of 1: the last bin holds 9 and 10
    assert counts == {**{b: 1 for b in range(9)}, 9: 2}
    beyond = spark.createDataFrame([(-5.0,), (50.0,), (1.0,), (None,)], "amount double")
    assert {r["bin"]: r["n"] for r in drift.bin_counts(beyond, moments, ["amount"]).collect()} == {0: 1, 9: 1, 1: 1}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "amount double")
    flat_moments = drift.numeric_moments(flat, ["amount"])
    shifted = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "amount double")
    assert {r["bin"]: r["n"] for r in drift.bin_counts(shifted, flat_moments, ["amount"]).collect()} == {0: 1, 9: 2}


def test_category_stability_by_hand(spark):
    rows = [("transaction_type", "category", k, v) for k, v in [("a", 0.5995), ("b", 0.4), ("rare", 0.0005)]]
    baseline = spark.createDataFrame(rows, "column string, kind string, key string, value double")
    current = spark.createDataFrame([("a",)] * 3 + [("new",)], "transaction_type string")
    got = drift.psi_categorical(current, baseline).first()["psi"]
    # in steps of 1/1000: a 599, b 400, the rare one vanishes
    a, b = 599 / 999, 400 / 999
    expected = (
        (0.75 - a) * math.log(0.75 / a) + (1e-4 - b) * math.log(1e-4 / b) + (0.25 - 1e-4) * math.log(0.25 / 1e-4)
    )
    assert got == round(expected, 4)


def test_drift_without_baseline_is_noted(spark, tx):
    rows = drift.check_drift(tx, None).collect()
    assert len(rows) == 1 and rows[0]["flagged"] is False and "not checked" in rows[0]["note"]


def test_same_data_does_not_drift(spark, tx):
    report = {(r["column"], r["measure"]): r for r in drift.check_drift(tx, drift.build_baseline(tx)).collect()}
    assert report[("amount", "psi")]["value"] == 0.0 and report[("*", "status")]["note"] == "STABLE"


def test_drift_with_nulls_and_of_empty_tables(spark, tx):
    columns = ["amount", "sender_balance_before", "receiver_balance_before", "transaction_type", "is_fraud"]
    schema = "amount double, sender_balance_before double, receiver_balance_before double, transaction_type string, is_fraud int"
    rows = [(float(i), None, 5.0, None if i % 4 == 0 else "ab"[i % 2], None if i == 3 else i % 2) for i in range(12)]
    mixed = spark.createDataFrame(rows, schema)
    held = {(r["column"], r["kind"], r["key"]): r["value"] for r in drift.build_baseline(mixed).collect()}
    assert held[("is_fraud", "rate", "mean")] == 5 / 11
    assert held[("transaction_type", "category", "a")] == 3 / 9 and held[("transaction_type", "category", "b")] == 6 / 9
    assert held[("sender_balance_before", "numeric", "mean")] is None
    assert sum(v for (c, k, _), v in held.items() if c == "amount" and k == "bin") == 12
    baseline = drift.build_baseline(mixed)
    report = {(r["column"], r["measure"]): r["value"] for r in drift.check_drift(mixed, baseline).collect()}
    assert report[("amount", "psi")] == 0.0 and report[("is_fraud", "rate_shift")] == 0.0
    singly = {r["column"]: r["psi"] for r in drift.psi_numeric(mixed, baseline).collect()}
    assert all(report[(c, "psi")] == v for c, v in singly.items())
    none = tx.select(*columns).limit(0)
    assert {r["column"] for r in drift.build_baseline(none).collect()} >= {*columns[:3], "is_fraud"}
    report = {(r["column"], r["measure"]): r["value"] for r in drift.check_drift(none, baseline).collect()}
    assert report[("is_fraud", "rate_shift")] is None


@pytest.fixture(scope="module")
def seven(spark):
    pairs = zip([0.1, 0.4, 0.35, 0.8, 0.8, 0.2, 0.6], [0, 0, 1, 1, 0, 0, 1])
    return spark.createDataFrame(list(pairs), "score double, is_fraud int")


def test_ranking_metrics_by_hand(seven):
    assert metrics.roc_auc(seven).first()[0] == 0.708333
    # the step sum; the trapezoid would be 0.544444
    assert metrics.average_precision(seven).first()[0] == 0.588889


def test_metrics_do_not_depend_on_the_size_of_the_score_table(seven, monkeypatch):
    """Many small buckets give the same figures and points as one."""
    small = [sorted(map(str, f(seven).collect())) for f in (metrics.ranking_metrics, metrics.roc_points, metrics.pr_points)]
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 2)
    large = [sorted(map(str, f(seven).collect())) for f in (metrics.ranking_metrics, metrics.roc_points, metrics.pr_points)]
    assert small == large


def test_roc_points_leave_out_straight_lines(seven):
    points = {(r["threshold"], r["fpr"], r["tpr"]) for r in metrics.roc_points(seven).collect()}
    assert points == {
        (INF, 0.0, 0.0), (0.8, 0.25, 0.333333), (0.6, 0.25, 0.666667), (0.4, 0.5, 0.666667), (0.35, 0.5, 1.0),
        (0.1, 1.0, 1.0),
    }
    assert metrics.roc_points(seven, drop_intermediate=False).count() == 7


def test_nearest_curve_point_ties(spark):
    points = spark.createDataFrame([(0.25, 0.5, 0.5), (0.75, 0.1, 0.9)], "threshold double, fpr double, tpr double")
    assert metrics.curve_point_at(points, [0.5], "roc").first()["threshold"] == 0.75
    renamed = points.toDF("threshold", "prec", "recall")
    assert metrics.curve_point_at(renamed, [0.5], "pr").first()["threshold"] == 0.25


@pytest.mark.parametrize("labels_in", [[0, 0, 0], [1, 1, 1], [1], [0]])
def test_metrics_of_one_class(spark, labels_in):
    df = spark.createDataFrame([(0.1 * i, y) for i, y in enumerate(labels_in)], "score double, is_fraud int")
    row = metrics.metrics_at_threshold(df, 0.9).first()
    assert (row["prec"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert metrics.roc_auc(df).first()[0] is None
    assert metrics.classification_report(df, 0.9).count() == 5
    assert sum(r["rows"] for r in metrics.confusion_matrix(df, 0.9).collect()) == len(labels_in)


def test_metrics_by_group(spark, seven):
    twice = seven.withColumn("model", F.lit("a")).unionByName(
        seven.select((1 - F.col("score")).alias("score"), "is_fraud", F.lit("b").alias("model"))
    )
    got = {r["model"]: r for r in metrics.ranking_metrics(twice, ["model"]).collect()}
    assert got["a"]["roc_auc"] == 0.708333 and got["b"]["roc_auc"] == 0.291667


def test_rates_leave_out_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "k string, is_fraud int")
    assert [tuple(r) for r in rates.rate_by(df, "k").collect()] == [("a", 2, 1, 50.0)]


def test_day_names_keep_empty_days(spark):
    df = spark.createDataFrame([("Monday", 1)], "day_name string, is_fraud int")
    got = rates.rate_by_day_name(df).collect()
    assert [r["day_number"] for r in got] == list(range(1, 8)) and got[1]["total"] == 0


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    row = rates.histogram(df, "x", 4, density=True).first()
    assert (row["bin"], row["bin_low"], row["bin_high"], row["rows"], row["density"]) == (2, 3.0, 3.25, 2, 4.0)
