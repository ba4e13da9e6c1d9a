"""Reference statistics and population stability.

A baseline is one long table ``(column, kind, key, value)``: moments, the row counts of ten equal-width bins, category
shares and the label rate. Its size depends on the number of bins and categories only. Storing the bin counts makes
the numeric index exact and repeatable; rebuilding the reference by random draws from a mean and a deviation would
be neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.numeric import ratio, rounded
from ledgerlens.operators.ordered import union_all
from ledgerlens.operators.sampling import hash_sample
from ledgerlens.operators.small import bounded, one_row, settled

# Fixed values.
DRIFT_NUMERIC = ["amount", "sender_balance_before", "receiver_balance_before"]
DRIFT_CATEGORICAL = ["transaction_type"]
DRIFT_LABEL = "is_fraud"
BINS = 10
EMPTY_SHARE = 1e-4
PSI_THRESHOLD = 0.2
RATE_SHIFT_THRESHOLD = 0.05
BASELINE_FRACTION = 0.8
SHARE_STEPS = 1000


def _bin_index(value: Column, low: Column, high: Column) -> Column:
    """Number of inner edges at or below the value: ten equal-width bins with open ends.

    The division gives the bin up to rounding; comparing with the two edges next to it settles the rest.
    """
    step = (high - low) / F.lit(float(BINS))
    last = F.lit(float(BINS - 1))
    guess = F.greatest(F.lit(0.0), F.least(last, F.floor(F.try_divide(value - low, step)).cast("double")))
    settled_bin = (
        F.when((guess < last) & (value >= low + (guess + 1) * step), guess + 1)
        .when((guess > 0) & (value < low + guess * step), guess - 1)
        .otherwise(guess)
    )
    flat = F.when(value >= low, last).otherwise(F.lit(0.0))
    return F.when(step == 0, flat).otherwise(settled_bin).cast("int")


def numeric_moments(df: DataFrame, columns: list[str] = DRIFT_NUMERIC) -> DataFrame:
    """``(column, mean, std, min, max)``, from one pass."""
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[fn(F.col(c).cast("double")).alias(f"{n}|{c}") for c in columns for n, fn in measures.items()])
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}|{c}").alias(n) for n in measures]) for c in columns
    ]
    return row.select(F.inline(F.array(*entries)))


def _bounds_row(moments: DataFrame, columns: list[str]) -> Column:
    """Each column's reference range as one struct (a scalar subquery)."""
    return one_row(
        moments.agg(*[F.max(F.when(F.col("column") == c, F.struct("min", "max"))).alias(c) for c in columns])
    )


def bin_counts(df: DataFrame, moments: DataFrame, columns: list[str] = DRIFT_NUMERIC) -> DataFrame:
    """Rows of each bin between the reference minimum and maximum: ``(column, bin, n)``, from one pass."""
    ranged = df.select(*columns).withColumn("_b", _bounds_row(moments, columns))
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).cast("double").alias("x"),
            F.col(f"_b.{c}.min").alias("low"),
            F.col(f"_b.{c}.max").alias("high"),
        )
        for c in columns
    ]
    long = ranged.select(F.inline(F.array(*entries))).where("x is not null")
    return long.groupBy("column", _bin_index(F.col("x"), F.col("low"), F.col("high")).alias("bin")).agg(
        F.count("*").alias("n")
    )


def category_counts(df: DataFrame, columns: list[str] = DRIFT_CATEGORICAL) -> DataFrame:
    """``(column, key, n)`` of the non-null values."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key")) for c in columns]
    return (
        df.select(F.inline(F.array(*entries)))
        .where("key is not null")
        .groupBy("column", "key")
        .agg(F.count("*").alias("n"))
    )


def build_baseline(df: DataFrame, label: bool = True) -> DataFrame:
    """The reference statistics of a table as ``(column, kind, key, value)``, from two scans.

    The first gives moments, categories and the label rate together; the second counts the bins, which need the range.
    """
    rate = label and DRIFT_LABEL in df.columns
    found = settled(_moments_and_categories(df, [DRIFT_LABEL] if rate else []))
    names = ["mean", "std", "min", "max"]
    numeric = F.broadcast(df.sparkSession.createDataFrame([(c,) for c in DRIFT_NUMERIC], "column string"))
    moments = bounded(numeric.join(found.where("key is null"), "column", "left").select("column", *names))
    total = F.sum("n").over(W.partitionBy("column"))
    categories = found.where(F.col("column").isin(DRIFT_CATEGORICAL) & F.col("key").isNotNull())
    entries = [
        F.struct(F.lit("numeric").alias("kind"), F.lit(n).alias("key"), F.col(n).alias("value")) for n in names
    ]
    parts = [
        moments.select("column", F.inline(F.array(*entries))),
        bin_counts(df, moments).select(
            "column", F.lit("bin").alias("kind"), F.col("bin").cast("string").alias("key"),
            F.col("n").cast("double").alias("value"),
        ),
        categories.select("column", F.lit("category").alias("kind"), "key", ratio(F.col("n"), total).alias("value")),
    ]
    if rate:
        parts.append(
            found.agg(F.max(F.when(F.col("column") == DRIFT_LABEL, F.col("mean"))).alias("value")).select(
                F.lit(DRIFT_LABEL).alias("column"), F.lit("rate").alias("kind"), F.lit("mean").alias("key"), "value"
            )
        )
    return union_all(parts)


def _moments_and_categories(df: DataFrame, labels: list[str]) -> DataFrame:
    """``(column, key, n, mean, std, min, max)`` from one scan: a row each numeric column and each category."""
    none = F.lit(None)
    entries = [
        F.struct(F.lit(c).alias("column"), none.cast("string").alias("key"), F.col(c).cast("double").alias("x"))
        for c in [*DRIFT_NUMERIC, *labels]
    ]
    entries += [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key"), none.cast("double").alias("x"))
        for c in DRIFT_CATEGORICAL
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .groupBy("column", "key")
        .agg(
            F.count("*").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
            F.min("x").alias("min"), F.max("x").alias("max"),
        )
    )


def baseline_sample(df: DataFrame, key: str = "transaction_id", fraction: float = BASELINE_FRACTION) -> DataFrame:
    """The rows a first baseline is taken from."""
    return hash_sample(df, fraction, key)


def stored_moments(baseline: DataFrame) -> DataFrame:
    numeric = baseline.where("kind = 'numeric'")
    return numeric.groupBy("column").agg(
        *[F.max(F.when(F.col("key") == n, F.col("value"))).alias(n) for n in ("mean", "std", "min", "max")]
    )


def _side(counts: DataFrame, side: str) -> DataFrame:
    """Counts as one side of a comparison: ``(column, key, ref_n, cur_n)``."""
    n, none = F.col("n").cast("double"), F.lit(0.0)
    return counts.select(
        "column",
        F.col("key").cast("string").alias("key"),
        (n if side == "ref" else none).alias("ref_n"),
        (n if side == "cur" else none).alias("cur_n"),
    )


def _psi(sides: DataFrame) -> DataFrame:
    """``(column, psi)`` of counts on two sides; what a side lacks counts as a small share there.

    Summing both sides by key lines them up like a full outer join, with one exchange of counted rows.
    """
    lined = sides.groupBy("column", "key").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
    whole = W.partitionBy("column")

    def share(name: str) -> Column:
        return F.when(F.col(name) == 0, F.lit(EMPTY_SHARE)).otherwise(ratio(F.col(name), F.sum(name).over(whole)))

    shares = lined.select("column", share("ref_n").alias("ref"), share("cur_n").alias("cur"))
    term = (F.col("cur") - F.col("ref")) * F.log(F.col("cur") / F.col("ref"))
    return shares.groupBy("column").agg(F.round(F.sum(term), 4).alias("psi"))


def _held_bins(baseline: DataFrame, columns: list[str]) -> DataFrame:
    """The reference side of numeric columns, every bin included."""
    held = baseline.where("kind = 'bin'").where(F.col("column").isin(columns))
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("column")
    every_bin = baseline.sparkSession.range(BINS).select(names, F.col("id").alias("key"), F.lit(0).alias("n"))
    return _side(every_bin, "ref").unionByName(_side(held.withColumnRenamed("value", "n"), "ref"))


def _held_categories(baseline: DataFrame, columns: list[str]) -> DataFrame:
    """The reference side of categorical columns."""
    steps = F.floor(F.col("value") * SHARE_STEPS).alias("n")
    held = baseline.where("kind = 'category'").where(F.col("column").isin(columns)).select("column", "key", steps)
    return _side(held.where("n > 0"), "ref")


def _numeric_sides(df: DataFrame, baseline: DataFrame, columns: list[str]) -> DataFrame:
    current = bin_counts(df, stored_moments(baseline), columns).withColumnRenamed("bin", "key")
    return _held_bins(baseline, columns).unionByName(_side(current, "cur"))


def _categorical_sides(df: DataFrame, baseline: DataFrame, columns: list[str]) -> DataFrame:
    return _held_categories(baseline, columns).unionByName(_side(category_counts(df, columns), "cur"))


def _current_counts(df: DataFrame, baseline: DataFrame, labels: list[str]) -> DataFrame:
    """``(column, key, n)`` of all bins, categories and label values, from one scan."""
    ranged = df.select(*DRIFT_NUMERIC, *DRIFT_CATEGORICAL, *labels).withColumn(
        "_b", _bounds_row(stored_moments(baseline), DRIFT_NUMERIC)
    )

    def entry(column: str, key: Column) -> Column:
        return F.struct(F.lit(column).alias("column"), key.cast("string").alias("key"))

    entries = []
    for c in DRIFT_NUMERIC:
        x = F.col(c).cast("double")
        entries.append(entry(c, F.when(x.isNotNull(), _bin_index(x, F.col(f"_b.{c}.min"), F.col(f"_b.{c}.max")))))
    entries += [entry(c, F.col(c)) for c in DRIFT_CATEGORICAL] + [entry(c, F.col(c).cast("double")) for c in labels]
    long = ranged.select(F.inline(F.array(*entries))).where("key is not null")
    return long.groupBy("column", "key").agg(F.count("*").alias("n"))


def psi_numeric(df: DataFrame, baseline: DataFrame, columns: list[str] = DRIFT_NUMERIC) -> DataFrame:
    """``(column, psi)`` over the ten reference bins. A bin without rows on a side counts as a small share there."""
    return _psi(_numeric_sides(df, baseline, columns))


def psi_categorical(df: DataFrame, baseline: DataFrame, columns: list[str] = DRIFT_CATEGORICAL) -> DataFrame:
    """``(column, psi)``. Reference shares are held in steps of 1/1000 and renormalised, so rarer ones vanish."""
    return _psi(_categorical_sides(df, baseline, columns))


def label_shift(df: DataFrame, baseline: DataFrame, threshold: float = RATE_SHIFT_THRESHOLD) -> DataFrame:
    """Absolute difference of the label rate; flagged strictly above the threshold."""
    return _shift(df.agg(F.avg(DRIFT_LABEL).alias("cur")), baseline, threshold)


def _shift(rate: DataFrame, baseline: DataFrame, threshold: float) -> DataFrame:
    """The label shift of a one-row table with the current rate ``cur``."""
    stored = baseline.where("kind = 'rate'").agg(F.max("value")).scalar()
    current = rate.withColumn("ref", stored)
    shift = F.abs(F.col("cur") - F.col("ref"))
    return current.select(
        F.lit(DRIFT_LABEL).alias("column"),
        F.round("ref", 4).alias("reference_rate"),
        F.round("cur", 4).alias("current_rate"),
        F.round(shift, 4).alias("shift"),
        (shift > threshold).alias("flagged"),
    )


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("flagged", T.BooleanType()),
        T.StructField("note", T.StringType()),
    ]
)


def check_drift(
    df: DataFrame,
    baseline: DataFrame | None,
    psi_threshold: float = PSI_THRESHOLD,
    shift_threshold: float = RATE_SHIFT_THRESHOLD,
) -> DataFrame:
    """``(column, measure, value, flagged, note)``, closed by a status row (``column = '*'``).

    Stability flags at or above its threshold. Without a baseline the report is one row that says so. Drift never
    fails a run: it warns.
    """
    if baseline is None:
        return df.sparkSession.createDataFrame(
            [("*", "status", None, False, "no reference statistics: drift not checked")], REPORT_SCHEMA
        )
    labels = [DRIFT_LABEL] if DRIFT_LABEL in df.columns else []
    # Counts of bins, categories and label values: a small table that both measures read.
    current = settled(_current_counts(df, baseline, labels))
    compared = _side(current.where(F.col("column") != DRIFT_LABEL), "cur")
    held = _held_bins(baseline, DRIFT_NUMERIC).unionByName(_held_categories(baseline, DRIFT_CATEGORICAL))
    scores = _psi(held.unionByName(compared)).select(
        "column",
        F.lit("psi").alias("measure"),
        F.col("psi").alias("value"),
        (F.col("psi") >= psi_threshold).alias("flagged"),
    )
    if labels:
        values = current.where(F.col("column") == DRIFT_LABEL).select(F.col("key").cast("double").alias("x"), "n")
        rate = values.agg(F.try_divide(F.sum(F.col("x") * F.col("n")), F.sum("n")).alias("cur"))
        scores = scores.unionByName(
            _shift(rate, baseline, shift_threshold).select(
                "column", F.lit("rate_shift").alias("measure"), F.col("shift").alias("value"), "flagged"
            )
        )
    any_flag = F.bool_or("flagged")
    # One pass over the few scores gives them and their status row.
    lines = F.collect_list(F.struct("column", "measure", "value", "flagged", F.lit(None).cast("string").alias("note")))
    status = F.struct(
        F.lit("*").alias("column"),
        F.lit("status").alias("measure"),
        F.lit(None).cast("double").alias("value"),
        any_flag.alias("flagged"),
        F.when(any_flag, "DRIFT DETECTED").otherwise("STABLE").alias("note"),
    )
    return scores.agg(F.concat(lines, F.array(status)).alias("lines")).select(F.inline("lines"))


def rolling_psi(df: DataFrame, column: str = "amount", days: int = 7) -> DataFrame:
    """Stability of each window of ``days`` days against the one before it: ``(window_start, psi)``.

    All windows share the bins of the whole table's range. The windowed counts are small; the window before is found
    by its index.
    """
    span = df.agg(F.min(column).alias("min"), F.max(column).alias("max"))
    first = F.lit("1970-01-05").cast("date")
    index = F.floor(F.datediff(F.to_date("timestamp"), first) / days).cast("int")
    placed = df.where(F.col(column).isNotNull() & F.col("timestamp").isNotNull()).select(
        index.alias("window_index"), F.col(column).alias("_x"), one_row(span).alias("_b")
    )
    placed = placed.select("window_index", _bin_index(F.col("_x"), F.col("_b.min"), F.col("_b.max")).alias("bin"))
    counts = placed.groupBy("window_index", "bin").agg(F.count("*").alias("n"))
    totals = counts.groupBy("window_index").agg(F.sum("n").alias("_total"))
    grid = totals.select("window_index", "_total", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"))
    shares = grid.join(counts, ["window_index", "bin"], "left").select(
        "window_index", "bin", F.coalesce(ratio(F.col("n"), F.col("_total")), F.lit(EMPTY_SHARE)).alias("cur")
    )
    before = shares.select((F.col("window_index") + 1).alias("window_index"), "bin", F.col("cur").alias("ref"))
    term = (F.col("cur") - F.col("ref")) * F.log(F.col("cur") / F.col("ref"))
    return (
        shares.join(before, ["window_index", "bin"])
        .groupBy("window_index")
        .agg(rounded(F.sum(term), 4).alias("psi"))
        .select(F.date_add(first, F.col("window_index") * days).alias("window_start"), "psi")
    )
