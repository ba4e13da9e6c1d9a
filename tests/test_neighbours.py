"""Exact neighbours and oversampling against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import neighbours
from ledgerlens.operators.neighbours import nearest_neighbours
from ledgerlens.operators.sampling import smote


def brute(frame, k):
    out = {}
    vectors = np.stack(frame.vec)
    for i, (name, vec) in enumerate(zip(frame.id, vectors)):
        distance = np.round(np.sqrt(((vectors - vec) ** 2).sum(axis=1)), 6)
        order = sorted((d, other) for j, (d, other) in enumerate(zip(distance, frame.id)) if j != i)
        out[name] = [other for _, other in order[:k]]
    return out


def frames():
    rng = np.random.default_rng(11)
    even = rng.normal(size=(300, 4))
    grid = rng.integers(0, 4, size=(300, 3)).astype(float)
    hot = np.vstack([np.zeros((150, 3)), rng.normal(size=(150, 3))])
    clusters = np.vstack([rng.normal(c, 0.05, size=(75, 2)) for c in (0, 5, 10, 20)])
    return {"even": even, "ties": grid, "copies": hot, "clusters": clusters}


@pytest.mark.parametrize("kind", ["even", "ties", "copies", "clusters"])
@pytest.mark.parametrize("leaf_points,chunk", [(2048, 4096), (16, 8)])
def test_neighbours_equal_brute_force(spark, kind, leaf_points, chunk):
    """One leaf, and many small leaves with split visitors, give the brute-force answer."""
    vectors = frames()[kind]
    frame = pd.DataFrame({"id": [f"p{i:03d}" for i in range(len(vectors))], "vec": list(vectors)})
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(frame.id, frame.vec)], "id string, vec array<double>")
    got = nearest_neighbours(df, "id", "vec", 5, leaf_points, chunk).toPandas()
    found = {name: part.sort_values("rank").neighbour.tolist() for name, part in got.groupby("id")}
    assert found == brute(frame, 5)


@pytest.mark.parametrize("kind", ["even", "clusters"])
def test_joined_and_sent_boxes_give_the_same_neighbours(spark, kind, monkeypatch):
    vectors = frames()[kind]
    frame = pd.DataFrame({"id": [f"p{i:03d}" for i in range(len(vectors))], "vec": list(vectors)})
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(frame.id, frame.vec)], "id string, vec array<double>")
    monkeypatch.setattr(neighbours, "SENT_BOXES", 0)
    got = nearest_neighbours(df, "id", "vec", 5, 16, 8).toPandas()
    assert {name: part.sort_values("rank").neighbour.tolist() for name, part in got.groupby("id")} == brute(frame, 5)


def test_leaves_are_dealt_to_tasks(spark, monkeypatch):
    """Few bytes in many leaves are not left to one task: neither the leaves nor their visitors."""
    rng = np.random.default_rng(4)
    rows = [(f"p{i}", v.tolist()) for i, v in enumerate(rng.normal(size=(400, 3)))]
    points = spark.createDataFrame(rows, "pid string, vec array<double>").selectExpr("pid", "vec", "array(pid) as ids")
    written, settle = [], neighbours.settled
    monkeypatch.setattr(neighbours, "settled", lambda df: written.append((df.columns, df.rdd.getNumPartitions())) or settle(df))
    monkeypatch.setattr(neighbours, "TASK_VISITS", 50)
    found = neighbours._nearest_points(points, 4, 50, 8)
    assert dict((tuple(c), n) for c, n in written)["leaf", "pid", "vec", "radius", "near"] == 8
    assert found.count() == 400


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([("a", [0.0]), ("b", [1.0])], "id string, vec array<double>")
    got = nearest_neighbours(df, "id", "vec", 5).toPandas()
    assert sorted(zip(got.id, got.neighbour)) == [("a", "b"), ("b", "a")]


@pytest.fixture(scope="module")
def oversampled(spark):
    rng = np.random.default_rng(5)
    rows = [(f"n{i}", float(x), float(y), 0) for i, (x, y) in enumerate(rng.normal(0, 1, (60, 2)))]
    rows += [(f"p{i}", float(x), float(y), 1) for i, (x, y) in enumerate(rng.normal(4, 1, (13, 2)))]
    df = spark.createDataFrame(rows, "transaction_id string, x double, y double, is_fraud int")
    return df, smote(df, ["x", "y"]).toPandas()


def test_oversampling_reaches_parity(oversampled):
    _, got = oversampled
    assert got.is_fraud.value_counts().to_dict() == {0: 60, 1: 60}
    assert (got.is_synthetic == 1).sum() == 47
    assert got.transaction_id.is_unique


def test_originals_are_unchanged(oversampled):
    df, got = oversampled
    kept = got[got.is_synthetic == 0].set_index("transaction_id")[["x", "y"]].sort_index()
    assert kept.equals(df.toPandas().set_index("transaction_id")[["x", "y"]].sort_index())


def test_synthetic_rows_lie_between_seed_and_neighbour(oversampled):
    df, got = oversampled
    positives = df.where("is_fraud = 1").toPandas()
    frame = pd.DataFrame({"id": positives.transaction_id, "vec": list(positives[["x", "y"]].to_numpy())})
    near, place = brute(frame, 5), dict(zip(frame.id, frame.vec))
    for row in got[got.is_synthetic == 1].itertuples():
        seed = row.transaction_id.split("~")[0]
        point = np.array([row.x, row.y]) - place[seed]
        gaps = []
        for other in near[seed]:
            way = place[other] - place[seed]
            share = float(point @ way) / float(way @ way)
            gaps.append(np.abs(point - share * way).max() if -1e-9 <= share <= 1 + 1e-9 else np.inf)
        assert min(gaps) < 1e-9


def test_seeds_are_used_evenly(oversampled):
    _, got = oversampled
    uses = got[got.is_synthetic == 1].transaction_id.str.split("~").str[0].value_counts()
    assert uses.max() - uses.min() <= 1


def test_oversampling_repeats_itself(oversampled):
    df, got = oversampled
    again = smote(df.repartition(7), ["x", "y"]).toPandas()
    order = ["transaction_id"]
    assert got.sort_values(order).reset_index(drop=True).equals(again.sort_values(order).reset_index(drop=True))


def test_balanced_input_is_left_alone(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 0)], "transaction_id string, x double, is_fraud int")
    assert smote(df, ["x"]).count() == 2
    assert smote(df.where(F.col("is_fraud") == 0), ["x"]).count() == 1
