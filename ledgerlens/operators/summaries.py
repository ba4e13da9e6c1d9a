"""Whole-table and per-group summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.geo import outside_kenya
from ledgerlens.functions.labels import age_bucket, range_label
from ledgerlens.functions.money import balance_remaining_pct
from ledgerlens.functions.numeric import flag, percent, ratio, rounded
from ledgerlens.functions.temporal import event_time, whole_days
from ledgerlens.operators.ordered import describe, quantile_bands, wide_quantiles
from ledgerlens.operators.profiles import device_pairs, receiver_pairs
from ledgerlens.operators.rates import LABEL, rate_by, with_volume_share
from ledgerlens.operators.small import bounded, settled


def dataset_overview(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, time range and distinct entities, as ``(item, value)``.

    All come from one scan: each row gives one (kind, id) for every entity column, and rows, times and frauds are
    combined by those in the map tasks, so the shuffle holds each different id once a task.
    """
    when = event_time(F.col("timestamp"))
    measures = {
        "rows": F.count("*"),
        "first_time": F.date_format(F.min("when"), "yyyy-MM-dd HH:mm:ss"),
        "last_time": F.date_format(F.max("when"), "yyyy-MM-dd HH:mm:ss"),
        "fraud": F.sum("label"),
    }
    entities = {
        "senders": "sender_id",
        "receivers": "receiver_id",
        "devices": "device_id",
        "transaction_types": "transaction_type",
    }
    slim = df.select(when.alias("when"), F.col(LABEL).alias("label"), *entities.values())
    if approximate:
        distinct = {n: F.approx_count_distinct(c) for n, c in entities.items()}
        found = slim.agg(*[m.cast("string").alias(n) for n, m in {**measures, **distinct}.items()])
    else:
        pairs = [F.struct(F.lit(n).alias("kind"), F.col(c).cast("string").alias("id")) for n, c in entities.items()]
        by_id = (
            slim.select("when", "label", F.inline(F.array(*pairs)))
            .groupBy("kind", "id")
            .agg(F.count("*").alias("n"), F.min("when").alias("first"), F.max("when").alias("last"), F.sum("label").alias("fraud"))
        )
        # Every row is in every kind, so one of them gives the totals.
        one = F.col("kind") == next(iter(entities))
        totals = {
            "rows": F.coalesce(F.sum(F.when(one, F.col("n"))), F.lit(0)),
            "first_time": F.date_format(F.min("first"), "yyyy-MM-dd HH:mm:ss"),
            "last_time": F.date_format(F.max("last"), "yyyy-MM-dd HH:mm:ss"),
            "fraud": F.sum(F.when(one, F.col("fraud"))),
        }
        distinct = {n: F.count(F.when(F.col("kind") == n, F.col("id"))) for n in entities}
        found = by_id.agg(*[m.cast("string").alias(n) for n, m in {**totals, **distinct}.items()])
    entries = [F.struct(F.lit(n).alias("item"), F.col(n).alias("value")) for n in [*measures, *entities]]
    return found.select(F.inline(F.array(*entries)))


def date_span(df: DataFrame) -> DataFrame:
    when = event_time(F.col("timestamp"))
    ends = df.agg(F.min(when).alias("first"), F.max(when).alias("last"))
    return ends.select(
        F.date_format("first", "yyyy-MM-dd").alias("first_day"),
        F.date_format("last", "yyyy-MM-dd").alias("last_day"),
        whole_days(F.col("last"), F.col("first")).alias("span_days"),
    )


def skew_and_cv(df: DataFrame, columns: list[str], digits: int = 5) -> DataFrame:
    """Bias-corrected skewness and coefficient of variation, one row a column."""
    aggregates = []
    for c in columns:
        n = F.count(c).cast("double")
        corrected = F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
        aggregates += [corrected.alias(f"{c}|skew"), ratio(F.stddev_samp(c), F.avg(c)).alias(f"{c}|cv")]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            rounded(F.col(f"{c}|skew"), digits).alias("skewness"),
            rounded(F.col(f"{c}|cv"), digits).alias("cv"),
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def amount_stats_by(df: DataFrame, key: str, digits: int = 4) -> DataFrame:
    """Count, mean, median, sample deviation, minimum and maximum of the amount."""
    return describe(df, ["amount"], [key], digits).select(
        key, "count", "mean", F.col("p50").alias("median"), "std", "min", "max"
    )


def type_overview(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rates with mean and median amount and volume share of each transaction type."""
    key = "transaction_type"
    means = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(LABEL).alias("total"),
            F.sum(LABEL).cast("bigint").alias("fraud"),
            rounded(F.avg("amount"), 4).alias("avg_amount"),
        )
        .withColumn("fraud_rate", rounded(percent(F.col("fraud"), F.col("total")), digits))
    )
    medians = wide_quantiles(df, "amount", {"median_amount": 0.5}, [key])
    return with_volume_share(means, digits).join(medians, key, "left").withColumn(
        "median_amount", rounded(F.col("median_amount"), 4)
    )


def velocity(df: DataFrame) -> DataFrame:
    """Transactions per sender, day and class."""
    day = F.to_date(event_time(F.col("timestamp")))
    return df.groupBy("sender_id", day.alias("date"), LABEL).agg(F.count("*").alias("tx_count"))


def velocity_stats(df: DataFrame, digits: int = 4) -> DataFrame:
    """``describe`` of the sender-day counts by class, with the 99th percentile over all of them.

    The sender-day counts are written once: the quantiles and the moments read them several times.
    """
    counts = settled(velocity(df).select(LABEL, "tx_count"))
    # The classes and all rows together are groups of one search.
    groups = counts.selectExpr(f"inline(array(struct(cast({LABEL} as string) as who, tx_count), struct('all' as who, tx_count)))")
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    quantiles = settled(wide_quantiles(groups, "tx_count", names, ["who"]))
    clip = quantiles.where("who = 'all'").select(F.max("p99"))
    moments = counts.where(F.col(LABEL).isNotNull()).groupBy(LABEL).agg(
        F.count("tx_count").alias("count"),
        F.avg("tx_count").alias("mean"),
        F.stddev_samp("tx_count").alias("std"),
        F.min("tx_count").cast("double").alias("min"),
        F.max("tx_count").cast("double").alias("max"),
    )
    summary = moments.join(quantiles, F.col(LABEL).cast("string") == F.col("who"))
    shown = [rounded(F.col(c), digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return summary.select(LABEL, "count", *shown).withColumn("clip_p99", rounded(clip.scalar(), digits))


def sender_activity(df: DataFrame) -> DataFrame:
    """Each sender's rows, positives, devices, receivers and mean amount."""
    per_device = (
        df.where("sender_id is not null")
        .groupBy("sender_id", "device_id")
        .agg(
            F.count("transaction_id").alias("tx"),
            F.sum(LABEL).alias("fraud"),
            F.sum("amount").alias("amount_sum"),
            F.count("amount").alias("amount_n"),
        )
    )
    by_device = per_device.groupBy("sender_id").agg(
        F.sum("tx").alias("total_tx"),
        F.sum("fraud").alias("fraud_tx"),
        F.count("device_id").alias("unique_devices"),
        F.try_divide(F.sum("amount_sum"), F.sum("amount_n")).alias("avg_amount"),
    )
    by_receiver = receiver_pairs(df).groupBy("sender_id").agg(F.count("receiver_id").alias("unique_receivers"))
    return by_device.join(by_receiver, "sender_id").withColumn(
        "fraud_rate", percent(F.col("fraud_tx"), F.col("total_tx"))
    )


def device_activity(df: DataFrame) -> DataFrame:
    """Each device's rows, positives and distinct senders."""
    per_sender = (
        df.where("device_id is not null")
        .groupBy("device_id", "sender_id")
        .agg(F.count("transaction_id").alias("tx"), F.sum(LABEL).alias("fraud"))
    )
    return (
        per_sender.groupBy("device_id")
        .agg(
            F.sum("tx").alias("total_tx"),
            F.sum("fraud").alias("fraud_tx"),
            F.count("sender_id").alias("unique_senders"),
        )
        .withColumn("fraud_rate", percent(F.col("fraud_tx"), F.col("total_tx")))
    )


def rate_by_sharing(activity: DataFrame, partners: str, name: str | None = None) -> DataFrame:
    """Rows, positives and their share by the number of partners, summed from a table of entities.

    ``activity`` has one row an entity (:func:`device_activity`), so the fact table is aggregated once and not joined.
    """
    summed = activity.groupBy(F.col(partners).alias(name or partners)).agg(
        F.sum("total_tx").alias("total"), F.sum("fraud_tx").alias("fraud")
    )
    rate = rounded(percent(F.col("fraud"), F.col("total")), 6)
    return summed.withColumn("fraud", F.col("fraud").cast("bigint")).withColumn("fraud_rate", rate)


def entity_summary(df: DataFrame) -> DataFrame:
    """Senders and devices: how many, mean and most rows, how many shared, how many with a positive."""

    def line(table: DataFrame, name: str, partners: str) -> DataFrame:
        return table.agg(
            F.lit(name).alias("entity"),
            F.count("*").alias("entities"),
            rounded(F.avg("total_tx"), 4).alias("mean_tx"),
            F.max("total_tx").alias("max_tx"),
            F.count_if(F.col(partners) > 1).alias("with_several"),
            F.count_if(F.col("fraud_tx") > 0).alias("with_fraud"),
        )

    senders = line(sender_activity(df), "sender", "unique_devices")
    return senders.unionByName(line(device_activity(df), "device", "unique_senders"))


def with_sender_devices(df: DataFrame) -> DataFrame:
    """Add each row's ``sender_unique_devices``. The per-sender table grows with senders: no broadcast hint."""
    counts = (
        device_pairs(df).where("sender_id is not null").groupBy("sender_id")
        .agg(F.count("device_id").alias("sender_unique_devices"))
    )
    return df.join(counts, "sender_id", "left")


def with_device_senders(df: DataFrame) -> DataFrame:
    """Add each row's ``device_unique_senders``."""
    counts = (
        device_pairs(df).where("device_id is not null").groupBy("device_id")
        .agg(F.count("sender_id").alias("device_unique_senders"))
    )
    return df.join(counts, "device_id", "left")


def with_unique_receivers(df: DataFrame) -> DataFrame:
    """Add ``unique_receivers`` and ``targets_single_receiver``."""
    counts = receiver_pairs(df).where("sender_id is not null").groupBy("sender_id").agg(
        F.count("receiver_id").alias("unique_receivers")
    )
    return df.join(counts, "sender_id", "left").withColumn(
        "targets_single_receiver", flag(F.col("unique_receivers") == 1)
    )


def receiver_diversity(df: DataFrame) -> DataFrame:
    """Senders by whether they have a positive: their number, receivers and rows; and rates of their rows.

    Every figure is a sum over senders, so the fact table is aggregated once and not joined back.
    """
    senders = sender_activity(df).select(
        flag(F.col("fraud_tx") > 0).alias("is_fraud_sender"),
        flag(F.col("unique_receivers") == 1).alias("targets_single_receiver"),
        "unique_receivers",
        "total_tx",
        "fraud_tx",
    )
    return senders.groupBy("is_fraud_sender", "targets_single_receiver").agg(
        F.count("*").alias("senders"),
        rounded(F.avg("unique_receivers"), 4).alias("mean_receivers"),
        F.max("unique_receivers").alias("max_receivers"),
        F.sum("total_tx").alias("rows"),
        rounded(percent(F.sum("fraud_tx"), F.sum("total_tx"))).alias("fraud_rate"),
    )


def with_account_age(df: DataFrame) -> DataFrame:
    """Add ``is_first_tx`` and ``account_age_days``.

    First times are aggregated and joined back: a window by sender would sort a hot sender's rows in one task.
    """
    when = event_time(F.col("timestamp"))
    firsts = df.where("sender_id is not null").groupBy("sender_id").agg(F.min(when).alias("_first"))
    return (
        df.join(firsts, "sender_id", "left")
        .withColumns(
            {
                "is_first_tx": flag(when == F.col("_first")),
                "account_age_days": whole_days(when, F.col("_first")),
            }
        )
        .drop("_first")
    )


def with_age_bucket(df: DataFrame) -> DataFrame:
    return with_account_age(df).withColumn("age_bucket", age_bucket(F.col("account_age_days")))


def type_balance(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the sender's balance of each transaction type."""
    known = df.where(F.col("transaction_type").isNotNull()).groupBy("transaction_type")
    before = "sender_balance_before"
    return bounded(known.agg(F.avg(before).alias("_mean"), F.stddev_samp(before).alias("_std")))


def with_type_balance(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Add ``is_high_value_target``, ``bal_to_type_avg_ratio`` and ``bal_to_type_mean``.

    The few type rows are broadcast where counted small, so the fact table is not shuffled by a five-value key.
    ``stats`` are those of other rows (:func:`type_balance`).
    """
    key, before = "transaction_type", "sender_balance_before"
    stats = type_balance(df) if stats is None else stats
    return (
        df.join(stats, key, "left")
        .withColumns(
            {
                "is_high_value_target": flag(F.col(before) > F.col("_mean") + F.lit(1.5) * F.col("_std")),
                "bal_to_type_avg_ratio": ratio(F.col(before), F.col("_mean") + F.lit(1e-9)),
                "bal_to_type_mean": ratio(F.col(before), F.col("_mean")),
            }
        )
        .drop("_mean", "_std")
    )


def amount_bands(df: DataFrame, bands: int = 8) -> DataFrame:
    """Rates of the equal-frequency amount bands with their range labels."""
    placed = quantile_bands(df, "amount", bands).withColumnRenamed("band", "amount_band")
    return rate_by(placed.where("amount_band is not null"), "amount_band", "band_low", "band_high").select(
        "amount_band",
        range_label(F.col("band_low"), F.col("band_high")).alias("band_range"),
        "total",
        "fraud",
        "fraud_rate",
    )


def geo_spread(df: DataFrame, digits: int = 6) -> DataFrame:
    """Range and sample deviation of the coordinates by class, and the share outside the country box."""
    lat, lon = F.col("location_lat"), F.col("location_lon")
    return df.groupBy(LABEL).agg(
        rounded(F.min(lat), 4).alias("lat_min"),
        rounded(F.max(lat), 4).alias("lat_max"),
        rounded(F.min(lon), 4).alias("lon_min"),
        rounded(F.max(lon), 4).alias("lon_max"),
        rounded(F.stddev_samp(lat), digits).alias("lat_std"),
        rounded(F.stddev_samp(lon), digits).alias("lon_std"),
        rounded(F.avg(flag(outside_kenya(lat, lon))) * 100, digits).alias("pct_outside"),
    )


def with_balance_remaining(df: DataFrame) -> DataFrame:
    return df.withColumn("balance_remaining_pct", balance_remaining_pct())


def box_stats(df: DataFrame, column: str, key: str, digits: int = 4) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and rows beyond them, by key."""
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = settled(wide_quantiles(df, column, names, [key]))  # a written table: its size tells whether it is broadcast
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.join(quartiles, key)
        .groupBy(key, *names)
        .agg(
            F.min(F.when(inside, F.col(column))).alias("whisker_low"),
            F.max(F.when(inside, F.col(column))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            key,
            *[rounded(F.col(c), digits).alias(c) for c in [*names, "whisker_low", "whisker_high"]],
            "outliers",
        )
        .orderBy(F.desc("median"), key)
    )


def medians_by(df: DataFrame, columns: list[str], key: str = LABEL) -> DataFrame:
    """Median of each column by key: ``(key, column, median)``."""
    return describe(df, columns, [key]).select(key, "column", F.col("p50").alias("median"))
