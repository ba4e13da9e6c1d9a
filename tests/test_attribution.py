"""Attributions against a brute force over all subsets of features."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import attribution, models

COLUMNS = ["a", "b", "c", "d"]


def expected(tree, place, x, known):
    """The tree's value where only the known features are followed; elsewhere both sides by their training rows."""
    node = tree[place]
    if node["leftChild"] < 0:
        return node["value"]
    left, right = node["leftChild"], node["rightChild"]
    feature, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
    if feature in known:
        return expected(tree, left if x[feature] <= cut else right, x, known)
    rows = tree[left]["rawCount"] + tree[right]["rawCount"]
    return sum(tree[c]["rawCount"] / rows * expected(tree, c, x, known) for c in (left, right))


def brute(trees, x, n):
    def value(known):
        return sum(expected(t, 0, x, known) for t in trees)

    out = []
    for i in range(n):
        rest, total = [j for j in range(n) if j != i], 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for known in itertools.combinations(rest, size):
                total += weight * (value({*known, i}) - value(set(known)))
        out.append(total)
    return out, value(set())


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(900).select(
        F.col("id").cast("string").alias("transaction_id"), *[F.round(F.rand(i), 2).alias(c) for i, c in enumerate(COLUMNS, 1)]
    )
    odd = F.col("a") + F.col("b") * F.col("c") > 0.8
    return made.withColumn("is_fraud", odd.cast("int")).cache()


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_equal_to_all_subsets(spark, rows, kind):
    estimator = models.gbt(6, maxDepth=3) if kind == "boosted" else models.random_forest(5, maxDepth=3)
    model = models.train(rows, COLUMNS, estimator)
    trees = {}
    for node in attribution.saved_nodes(model, spark).select("tree", "weight", "nodeData.*").collect():
        node = node.asDict(recursive=True)
        stats = node["impurityStats"]
        node["value"] = node["prediction"] * node["weight"] if kind == "boosted" else stats[1] / sum(stats) / 5
        trees.setdefault(node["tree"], {})[node["id"]] = node
    some = rows.limit(12)
    found = {r["transaction_id"]: r for r in attribution.attributions(some, model, COLUMNS).collect()}
    for r in some.collect():
        want, base = brute(list(trees.values()), [r[c] for c in COLUMNS], 4)
        got = found[r["transaction_id"]]
        assert np.allclose([got[c] for c in COLUMNS], want, atol=1e-12)
        assert abs(got["base_value"] - base) < 1e-12


@pytest.mark.parametrize("depth", [1, 5, 8])
def test_contributions_add_up_to_the_raw_score(spark, rows, depth):
    model = models.train(rows, COLUMNS, models.gbt(4, maxDepth=depth))
    scored = models.with_score(rows, model).select("transaction_id", "score")
    both = attribution.attributions(rows, model, COLUMNS).join(scored, "transaction_id")
    gap = both.select(F.max(F.abs(F.col("score") - 1 / (1 + F.exp(-2 * F.col("raw_score")))))).first()[0]
    assert gap < 1e-9


def test_a_tree_without_a_split(spark, rows):
    model = models.train(rows.withColumn("a", F.lit(1.0)).limit(30), ["a"], models.gbt(1, maxDepth=2))
    found = attribution.attributions(rows.limit(3), model, ["a"]).collect()
    assert all(r["a"] == 0 and r["raw_score"] == r["base_value"] for r in found)


def test_an_empty_table_and_the_means(spark, rows):
    model = models.train(rows, COLUMNS, models.gbt(3, maxDepth=3))
    assert attribution.attributions(rows.limit(0), model, COLUMNS).count() == 0
    whole = attribution.attributions(rows, model, COLUMNS)
    means = {r["feature"]: r for r in attribution.mean_attribution(whole, COLUMNS).collect()}
    assert set(means) == set(COLUMNS)
    assert means["a"]["mean_abs"] == round(whole.select(F.avg(F.abs("a"))).first()[0], 9)


def test_rows_that_a_tree_cannot_tell_apart_are_worked_on_once(spark, rows, monkeypatch):
    """By tables, by integrals, and row by row the parts are the same; a tree is asked once for each kind of row."""
    paths = attribution.paths_of(models.train(rows, COLUMNS, models.gbt(5, maxDepth=3)), spark)
    x = np.random.default_rng(3).uniform(-0.2, 1.2, (4000, 4))
    x[:50, 1] = np.nan
    asked = []
    added = attribution._Tree.added
    monkeypatch.setattr(attribution._Tree, "added", lambda tree, some: asked.append(len(some)) or added(tree, some))
    found = attribution.contributions(attribution.trees_of(paths), x)
    assert max(asked) < 400
    monkeypatch.setattr(attribution, "TABLE_CELLS", 0)
    assert np.allclose(found, attribution.contributions(attribution.trees_of(paths), x), atol=1e-13)
    alone = [attribution.contributions(attribution.trees_of(paths), row[None]) for row in x[::97]]
    assert np.allclose(found[::97], np.concatenate(alone), atol=1e-13)
    assert attribution.contributions(attribution.trees_of(paths), x[:0]).shape == (0, 4)
