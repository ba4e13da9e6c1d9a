"""Logistic regressions fitted together equal those that Spark ML fits one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from ledgerlens.operators import logistic, models
from ledgerlens.operators.sampling import with_class_weight
from ledgerlens.operators.small import settled

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(0, 3000, 1, 5).select(
        "id", *[(F.randn(i) * i).alias(c) for i, c in enumerate(COLUMNS, 1)], F.pmod(F.xxhash64("id"), F.lit(3)).cast("int").alias("fold")
    )
    margin = F.col("a") * 1.5 - F.col("b") * 0.5 - 1.2 + F.randn(9)
    return settled(made.withColumn("is_fraud", (margin > 0).cast("int")))


def spark_ml(df, columns, weight, penalty):
    estimator = LogisticRegression(
        labelCol="is_fraud", featuresCol="features", weightCol="weight", regParam=penalty, standardization=False, tol=1e-13, maxIter=500
    )
    found = models.train(with_class_weight(df, weight), columns, estimator).stages[-1]
    return [found.intercept, *found.coefficients.toArray()]


def test_equal_to_spark_ml(rows):
    fits = [
        logistic.Fit("plain", tuple(COLUMNS), 1.0, 0.01),
        logistic.Fit("weighted", tuple(COLUMNS), 15.0, 0.1),
        logistic.Fit("two", ("a", "c"), 3.0, 0.001),
        logistic.Fit("fold", tuple(COLUMNS), 5.0, 0.02, held_out=1),
        logistic.Fit("free", tuple(COLUMNS), 1.0, 0.0),
    ]
    for fit, found in zip(fits, logistic.fit_all(rows, fits), strict=True):
        part = rows if fit.held_out is None else rows.where(F.col("fold") != fit.held_out)
        want = spark_ml(part, list(fit.features), fit.positive_weight, fit.penalty)
        assert np.allclose([found.intercept, *found.coefficients.values()], want, atol=1e-6), fit.name


def test_c_is_the_inverse_penalty_on_the_sum(rows):
    total = rows.agg(F.sum(F.when(F.col("is_fraud") == 1, 4.0).otherwise(1.0))).first()[0]
    fits = [logistic.Fit("c", tuple(COLUMNS), 4.0, c=0.5), logistic.Fit("p", tuple(COLUMNS), 4.0, penalty=1 / (0.5 * total))]
    one, two = logistic.fit_all(rows, fits)
    assert np.allclose(list(one.coefficients.values()), list(two.coefficients.values()), atol=1e-9)


def test_counts_and_scores(rows):
    fitted = logistic.fit_all(rows, [logistic.Fit("x", tuple(COLUMNS), 2.0, 0.01, held_out=k) for k in range(3)])
    for counts, model in zip(logistic.held_out_counts(rows, fitted), fitted, strict=True):
        scored = logistic.with_scores(rows.where(F.col("fold") == model.fit.held_out), model)
        above, positive = F.col("score") >= 0.5, F.col("is_fraud") == 1
        cells = [above & positive, above & ~positive, ~above & positive, ~above & ~positive]
        assert tuple(counts.values()) == tuple(scored.agg(*[F.count_if(c) for c in cells]).first())


def test_grid(rows):
    trials, best = logistic.grid_search(rows, COLUMNS, [0.01, 1.0], [1.0, 20.0], 3)
    assert len(trials) == 4 and best.fit.held_out is None
    top = max(trials, key=lambda t: (t["mean_recall"], -t["trial"]))
    assert (best.fit.c, best.fit.positive_weight) == (top["c"], top["positive_weight"]) and top["positive_weight"] == 20.0
    part = rows.where("fold <> 0")
    total = with_class_weight(part, 20.0).agg(F.sum("weight")).first()[0]
    want = spark_ml(part, COLUMNS, 20.0, 1 / (0.01 * total))
    found = logistic.fit_all(rows, [logistic.Fit("x", tuple(COLUMNS), 20.0, c=0.01, held_out=0)])[0]
    assert np.allclose([found.intercept, *found.coefficients.values()], want, atol=1e-6)


def test_one_label_no_rows_and_nulls(rows, spark):
    only = rows.where("is_fraud = 0")
    assert logistic.fit_all(only, [logistic.Fit("x", ("a",), 1.0, 0.1)])[0].coefficients is None
    assert logistic.fit_all(rows.limit(0), [logistic.Fit("x", ("a",), 1.0, 0.1)])[0].intercept is None
    odd = rows.unionByName(spark.sql("select 9999L id, cast(null as double) a, 1.0D b, 1.0D c, 0 fold, 1 is_fraud"))
    fit = [logistic.Fit("x", tuple(COLUMNS), 1.0, 0.1)]
    one, two = logistic.fit_all(odd, fit)[0], logistic.fit_all(rows, fit)[0]
    assert np.allclose(list(one.coefficients.values()), list(two.coefficients.values()), atol=1e-12)


def test_separable_rows_with_a_small_penalty_converge(spark):
    rows = spark.range(200).select((F.col("id") / 100.0 - 1).alias("a"), (F.col("id") >= 100).cast("int").alias("is_fraud"))
    found = logistic.fit_all(rows, [logistic.Fit("x", ("a",), 1.0, 1e-6)])[0]
    assert found.steps < logistic.MOST_STEPS and found.coefficients["a"] > 10
