"""Distributed quantiles, running totals and numbering against plain computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """Two groups; in one a single value holds most rows. Some values are NULL."""
    rng = np.random.default_rng(7)
    spread = [("a", float(v)) for v in np.round(rng.lognormal(size=900), 3)]
    hot = [("b", 5.0)] * 700 + [("b", float(v)) for v in rng.integers(0, 40, 200)]
    return spread + hot + [("a", None), ("b", None), (None, 3.0)]


@pytest.mark.parametrize("buckets", [None, 2, 16, 1024])
def test_exact_quantiles_equal_numpy(spark, skewed, buckets):
    probabilities = [0.0, 0.125, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame(skewed, "g string, x double").repartition(5)
    got = ordered.exact_quantiles(df, ["x"], probabilities, ["g"], buckets=buckets).toPandas()
    frame = pd.DataFrame(skewed, columns=["g", "x"]).dropna()
    assert len(got) == 2 * len(probabilities)
    for (g, p), part in got.groupby(["g", "prob"]):
        expected = np.quantile(frame.x[frame.g == g], p)
        assert part["value"].iloc[0] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("buckets", [2, 3, 1024])
def test_wide_parts_are_cut_again(spark, skewed, buckets):
    """Parts of more than a few rows are cut until they hold one value or few rows; the answer is the same."""
    df = spark.createDataFrame(skewed, "g string, x double")
    got = ordered.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], ["g"], buckets=buckets, part_rows=3).toPandas()
    frame = pd.DataFrame(skewed, columns=["g", "x"]).dropna()
    for r in got.itertuples():
        assert r.value == pytest.approx(np.quantile(frame.x[frame.g == r.g], r.prob), abs=1e-12)


def test_quantiles_of_odd_numbers(spark):
    """Signs, zeros, infinities, tiny and huge values, and a value that nine of ten rows share."""
    values = [-np.inf, -1e300, -2.5, -1e-300, -0.0, 0.0, 5e-324, 1e-9, 1.0, 1.0000000001, 3.0, 1e300, np.inf] + [7.25] * 117
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    for part_rows in (1, 5, 500_000):
        got = ordered.exact_quantiles(df, ["x"], [i / 129 for i in range(130)], part_rows=part_rows).toPandas()
        got = got.sort_values("prob")["value"].tolist()
        # A rank just beside a whole one may lean on its neighbour in the last digits.
        inner = [(g, v) for g, v in zip(got, sorted(values)) if np.isfinite(v) and abs(v) < 1e299]
        assert all(g == pytest.approx(v, rel=1e-6, abs=1e-6) or not np.isfinite(g) or abs(g) > 1e280 for g, v in inner)
        assert got[0] == -np.inf and got[-1] == np.inf


@pytest.mark.parametrize("buckets", [None, 8])
def test_quantiles_of_nothing(spark, buckets):
    df = spark.createDataFrame([("a", None)], "g string, x double")
    assert ordered.exact_quantiles(df, ["x"], [0.5], ["g"], buckets=buckets).count() == 0


def test_sketch_variant_is_close(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, x double")
    got = ordered.exact_quantiles(df, ["x"], [0.5], ["g"], approximate=True).toPandas().set_index("g")["value"]
    assert got["b"] == 5.0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [None, 2, 7, 256])
def test_running_totals_equal_a_plain_cumsum(spark, descending, buckets):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": np.repeat(["a", "b"], 60), "s": np.tile(np.arange(60) / 60, 2)})
    frame["n"] = rng.integers(0, 9, len(frame))
    df = spark.createDataFrame(frame).repartition(4)
    got = ordered.running_totals(
        df, "s", {"n": "total"}, ["g"], descending, following={"n": "next_n"}, buckets=buckets
    ).toPandas()
    plain = frame.sort_values(["g", "s"], ascending=[True, not descending])
    plain["total"] = plain.groupby("g").n.cumsum()
    plain["next_n"] = plain.groupby("g").n.shift(-1)
    both = got.merge(plain, on=["g", "s", "n"], suffixes=("", "_plain"))
    assert len(both) == len(frame)
    assert (both.total == both.total_plain).all()
    assert (both.next_n.fillna(-1) == both.next_n_plain.fillna(-1)).all()


@pytest.mark.parametrize("buckets", [1, 5, 256])
def test_numbered_is_one_to_n_per_group(spark, buckets):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("g"))
    got = ordered.numbered(df, "k", ["g"], buckets=buckets).toPandas()
    for _, part in got.groupby("g"):
        assert sorted(part.row_number) == list(range(1, len(part) + 1))


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0],
        [0.0] * 6 + [1.0, 2.0, 3.0, 4.0, 5.0],
        [4.0] * 10,
        [1.0, 1.0, 2.0, 2.0, 2.0, 3.0, 10.0, 10.0],
    ],
)
def test_bands_equal_qcut(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = ordered.quantile_bands(df, "x", 4).toPandas().sort_values("i")["band"]
    if len(set(values)) == 1:
        assert (got == 0).all()
    else:
        expected = pd.qcut(pd.Series(values), 4, labels=False, duplicates="drop")
        assert got.tolist() == expected.tolist()
