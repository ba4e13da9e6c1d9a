"""Label rates by key, pivots and what is read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import percent, ratio, rounded
from ledgerlens.functions.temporal import DAY_NAMES
from ledgerlens.operators.small import any_null, bounded, one_row

LABEL = "is_fraud"


def rate_by(df: DataFrame, *keys: str, digits: int | None = 6) -> DataFrame:
    """Rows, positives and positive rate in percent by key. Rows with a NULL key are left out.

    ``digits=None`` keeps the rate as computed.

    Partial aggregation leaves one row per key and map task before the shuffle, so a hot key costs nothing.
    """
    kept = df.where(~any_null(list(keys)))
    counts = kept.groupBy(*keys).agg(F.count(LABEL).alias("total"), F.sum(LABEL).cast("bigint").alias("fraud"))
    rate = percent(F.col("fraud"), F.col("total"))
    return counts.withColumn("fraud_rate", rate if digits is None else rounded(rate, digits))


def with_volume_share(rates: DataFrame, digits: int = 6) -> DataFrame:
    """Add each key's share of all rows. The window runs over the rate table, one row a key."""
    total = F.sum("total").over(W.partitionBy(F.lit(0)))
    return rates.withColumn("pct_of_volume", rounded(percent(F.col("total"), total), digits))


def rate_by_day_name(df: DataFrame, day: str = "day_name") -> DataFrame:
    """Rates for the seven day names in calendar order; a day without rows stays, with a NULL rate."""
    spark = df.sparkSession
    calendar = spark.range(7).select(
        (F.col("id") + 1).cast("int").alias("day_number"),
        F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), F.col("id").cast("int")).alias(day),
    )
    return (
        calendar.join(rate_by(df, day), day, "left")
        .select(
            "day_number",
            day,
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("fraud", F.lit(0)).alias("fraud"),
            "fraud_rate",
        )
        .orderBy("day_number")
    )


def top_rates(rates: DataFrame, n: int, min_total: int = 1) -> DataFrame:
    """The ``n`` highest rates among keys with enough rows; ties go to the lower keys."""
    keys = [c for c in rates.columns if c not in ("total", "fraud", "fraud_rate")]
    return rates.where(F.col("total") >= min_total).orderBy(F.desc("fraud_rate"), *keys).limit(n)


def lowest_keys(rates: DataFrame, key: str, n: int) -> DataFrame:
    """The rates of the ``n`` lowest keys."""
    return rates.orderBy(key).limit(n)


def peaks(rates: DataFrame, key: str) -> DataFrame:
    """The keys with the highest rate, the lowest rate and the most rows; a tie goes to the lowest key."""
    return rates.agg(
        F.min_by(key, F.struct(-F.col("fraud_rate"), F.col(key))).alias("highest_rate"),
        F.min_by(key, F.struct(F.col("fraud_rate"), F.col(key))).alias("lowest_rate"),
        F.min_by(key, F.struct(-F.col("total"), F.col(key))).alias("most_rows"),
    )


def mean_rate_over(rates: DataFrame, key: str, values: list) -> DataFrame:
    """The plain mean of the rates of some keys (each key weighs the same)."""
    return rates.where(F.col(key).isin(values)).agg(
        F.avg("fraud_rate").alias("mean_rate"), F.count("*").alias("keys")
    )


def above_overall(df: DataFrame, key: str, out: str) -> DataFrame:
    """Flag the rows whose key has a higher rate than the whole table.

    The keys above the rate are a small table: broadcast where its counted size allows.
    """
    counts = df.groupBy(key).agg(F.sum(LABEL).alias("_pos"), F.count(LABEL).alias("_n"))
    whole = W.partitionBy(F.lit(0))
    overall = ratio(F.sum("_pos").over(whole), F.sum("_n").over(whole))
    marked = counts.select(key, (ratio(F.col("_pos"), F.col("_n")) > overall).alias("_above"))
    high = bounded(marked.where(F.col("_above") & F.col(key).isNotNull()).select(key, F.lit(1).alias(out)))
    return df.join(high, key, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def class_balance(df: DataFrame) -> DataFrame:
    rate = F.avg(LABEL)
    return df.agg(
        F.count(LABEL).alias("total"),
        F.sum(LABEL).cast("bigint").alias("fraud"),
        rounded(rate).alias("fraud_rate"),
        rounded(ratio(1 - rate, rate), 4).alias("imbalance_ratio"),
        rounded(1 - rate).alias("baseline_accuracy"),
    )


def cumulative_by(df: DataFrame, date: str) -> DataFrame:
    """Running rows and positives by date. The window runs over one row a day, not over transactions."""
    daily = df.where(F.col(date).isNotNull()).groupBy(date).agg(
        F.sum(LABEL).cast("bigint").alias("daily_fraud"), F.count(LABEL).alias("daily_total")
    )
    upto = W.partitionBy(F.lit(0)).orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    return daily.select(
        "*",
        F.sum("daily_fraud").over(upto).alias("cumulative_fraud"),
        F.sum("daily_total").over(upto).alias("cumulative_total"),
    )


def linear_trend(rates: DataFrame, x: str, y: str = "fraud_rate", digits: int = 6) -> DataFrame:
    """Least-squares line of ``y`` over ``x``."""
    return rates.agg(
        rounded(F.regr_slope(y, F.col(x).cast("double")), digits).alias("slope"),
        rounded(F.regr_intercept(y, F.col(x).cast("double")), digits).alias("intercept"),
    )


def pivot_table(
    df: DataFrame, rows: str, columns: str, names: dict, value: Column, fill: float | int | None = None
) -> DataFrame:
    """``value`` aggregated by ``rows`` and by the listed values of ``columns``.

    ``names`` maps each pivot value to its output column, so no job is needed to find the values.
    """
    table = df.where(~any_null([rows])).groupBy(rows).pivot(columns, list(names)).agg(value)
    renamed = table.select(rows, *[F.col(f"`{v}`").alias(n) for v, n in names.items()])
    return renamed if fill is None else renamed.fillna(fill, list(names.values()))


def value_counts(df: DataFrame, key: str, within: str | None = None, digits: int = 6) -> DataFrame:
    """Rows per value with their share in percent of all rows, or of their ``within`` group.

    The share's window runs over the counted table.
    """
    keys = [within, key] if within else [key]
    counts = df.where(~any_null(keys)).groupBy(*keys).agg(F.count("*").alias("rows"))
    if within:
        whole = F.sum("rows").over(W.partitionBy(within))
    else:
        whole = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("pct", rounded(percent(F.col("rows"), whole), digits))


def conditional_shares(df: DataFrame, conditions: dict[str, Column], by: str = LABEL, digits: int = 6) -> DataFrame:
    """The share in percent of each class's rows that meet each condition."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        *[
            rounded(F.avg(F.when(c, 1.0).otherwise(0.0)) * 100, digits).alias(name)
            for name, c in conditions.items()
        ]
    )


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    by: str | None = None,
    density: bool = False,
    clip_high: Column | None = None,
    clip_low: Column | None = None,
) -> DataFrame:
    """Equal-width bins over the whole range; the last bin is closed. ``(by, bin, bin_low, bin_high, rows)``.

    The range is a scalar subquery, so rows are binned as they are scanned; empty bins are not listed. With ``by``
    all groups share the bins; ``density`` adds each group's rows per unit of width.
    """
    value = F.col(column).cast("double")
    if clip_high is not None:
        value = F.when(value.isNotNull(), F.least(value, clip_high))
    if clip_low is not None:
        value = F.when(value.isNotNull(), F.greatest(value, clip_low))
    keys = [by] if by else []
    numbers = df.select(*keys, value.alias("x")).where(~any_null(keys + ["x"]))
    span = numbers.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    widened = span.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).select("lo", ((F.col("hi") - F.col("lo")) / bins).alias("width"))
    placed = numbers.withColumn("_r", one_row(widened))
    index = F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("_r.lo")) / F.col("_r.width"))).cast("int")
    counts = placed.groupBy(*keys, index.alias("bin"), "_r").agg(F.count("*").alias("rows"))
    low = F.col("_r.lo") + F.col("bin") * F.col("_r.width")
    out = counts.select(
        *keys,
        "bin",
        rounded(low).alias("bin_low"),
        rounded(low + F.col("_r.width")).alias("bin_high"),
        "rows",
        F.col("_r.width").alias("_width"),
    )
    if density:
        whole = F.sum("rows").over(W.partitionBy(*(keys or [F.lit(0)])))
        out = out.withColumn("density", rounded(F.col("rows") / (whole * F.col("_width")), 8))
    return out.drop("_width")
