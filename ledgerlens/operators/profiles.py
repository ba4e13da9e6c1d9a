"""Sender and device profiles.

The additive core is the pair table: one row per (sender, device) with counts and sums. It answers the sender's
totals, devices and primary device and the device's senders from one shuffle of the fact table, instead of one
expanded row per distinct count; a hot sender is combined on the map side before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.temporal import event_time
from ledgerlens.operators.ordered import exact_quantiles
from ledgerlens.operators.small import settled

# Fallbacks that are not medians.
FALLBACK_DEVICE_SWITCH = 0
FALLBACK_DEVICE_SENDERS = 1


@dataclass(frozen=True)
class Profiles:
    """The stored state features are derived from."""

    sender: DataFrame
    device: DataFrame
    fallbacks: DataFrame


def device_pairs(tx: DataFrame) -> DataFrame:
    """One row per (sender, device): rows, ids, amounts and their sum. Merges by addition."""
    return tx.groupBy("sender_id", "device_id").agg(
        F.count("*").alias("uses"),
        F.count("transaction_id").alias("tx"),
        F.sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_n"),
    )


def receiver_pairs(tx: DataFrame) -> DataFrame:
    """The distinct (sender, receiver) pairs. Merges by union."""
    return tx.select("sender_id", "receiver_id").distinct()


def primary_device(pairs: DataFrame) -> DataFrame:
    """Each sender's most used device; a tie goes to the lowest device id."""
    rank = F.struct(-F.col("uses"), F.col("device_id"))
    return (
        pairs.where("sender_id is not null and device_id is not null")
        .groupBy("sender_id")
        .agg(F.min_by("device_id", rank).alias("primary_device"), F.max("uses").alias("uses"))
    )


def sender_profile(device_pair_table: DataFrame, receiver_pair_table: DataFrame) -> DataFrame:
    """Totals, distinct counterparts, mean amount and primary device of each sender.

    Both sides end hashed by sender, so their join needs no exchange of its own.
    """
    rank = F.when(F.col("device_id").isNotNull(), F.struct(-F.col("uses"), F.col("device_id")))
    by_device = (
        device_pair_table.where("sender_id is not null")
        .groupBy("sender_id")
        .agg(
            F.sum("tx").alias("total_tx"),
            F.count("device_id").alias("unique_devices"),
            F.try_divide(F.sum("amount_sum"), F.sum("amount_n")).alias("avg_amount"),
            F.min_by("device_id", rank).alias("primary_device"),
        )
    )
    by_receiver = (
        receiver_pair_table.where("sender_id is not null")
        .groupBy("sender_id")
        .agg(F.count("receiver_id").alias("unique_recv"))
    )
    return by_device.join(by_receiver, "sender_id").select(
        "sender_id", "total_tx", "unique_recv", "unique_devices", "avg_amount", "primary_device"
    )


def device_profile(pairs: DataFrame) -> DataFrame:
    return (
        pairs.where("device_id is not null")
        .groupBy("device_id")
        .agg(F.count("sender_id").alias("unique_senders"))
    )


def profile_fallbacks(sender: DataFrame, approximate: bool = False) -> DataFrame:
    """One row of medians over the profile rows (not over transactions); whole-number ones are cut to integers."""
    names = ["total_tx", "unique_recv", "unique_devices", "avg_amount"]
    medians = exact_quantiles(sender, names, [0.5], approximate=approximate)
    picked = {n: F.max(F.when(F.col("column") == n, F.col("value"))) for n in names}
    return medians.agg(
        *[v.cast("int" if n != "avg_amount" else "double").alias(n) for n, v in picked.items()],
        F.lit(FALLBACK_DEVICE_SWITCH).alias("is_device_switch"),
        F.lit(FALLBACK_DEVICE_SENDERS).alias("unique_senders"),
    )


def sender_and_device(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two profile tables of a transaction table, lazily."""
    pairs = device_pairs(tx)
    return sender_profile(pairs, receiver_pairs(tx)), device_profile(pairs)


def fit_profiles(tx: DataFrame) -> Profiles:
    """Profiles and fallbacks. The pair table and the sender profile are written once, since several plans read them."""
    pairs = settled(device_pairs(tx))
    sender = settled(sender_profile(pairs, receiver_pairs(tx)))
    return Profiles(sender, device_profile(pairs), profile_fallbacks(sender))


def recent(tx: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """The rows of the last ``days`` days before ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    when = event_time(F.col("timestamp"))
    return tx.where((when >= end - F.expr(f"interval {int(days)} days")) & (when < end))


def refresh_profiles(old: Profiles, tx: DataFrame, as_of: str, days: int = 90) -> Profiles:
    """Rebuild the two tables from a recent window; the fallbacks stay as fitted."""
    sender, device = sender_and_device(recent(tx, as_of, days))
    return Profiles(sender, device, old.fallbacks)
