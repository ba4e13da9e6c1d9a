"""The 21 model features of a transaction table, from stored profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.geo import geographic_features
from ledgerlens.functions.money import amount_features, balance_features, balance_remaining_pct, type_code
from ledgerlens.functions.numeric import flag
from ledgerlens.functions.temporal import temporal_features
from ledgerlens.operators.ordered import band_edges, band_of
from ledgerlens.operators.profiles import Profiles
from ledgerlens.operators.small import one_row, settled
from ledgerlens.operators.summaries import type_balance, with_type_balance

# The feature list and the columns that are not scaled.
FEATURES = [
    "hour",
    "day_of_week",
    "month",
    "is_night",
    "is_weekend",
    "log_amount",
    "is_high_value",
    "amount_vs_sender_avg",
    "balance_drain_rate",
    "sender_balance_change",
    "receiver_balance_change",
    "balance_discrepancy",
    "amount_to_balance_ratio",
    "dist_from_nairobi",
    "is_outside_kenya",
    "sender_total_tx",
    "sender_unique_recv",
    "sender_unique_devices",
    "is_device_switch",
    "device_unique_senders",
    "transaction_type_enc",
]
NOT_SCALED = [
    "is_night",
    "is_weekend",
    "is_high_value",
    "is_outside_kenya",
    "is_device_switch",
    "balance_discrepancy",
    "transaction_type_enc",
]
SCALED = [name for name in FEATURES if name not in NOT_SCALED]
# The exploratory feature list, its unscaled columns beyond those above, and what its second iteration drops.
EXTENDED = [
    "hour",
    "day_of_week",
    "month",
    "is_night",
    "is_weekend",
    "sender_total_tx",
    "log_amount",
    "is_high_value",
    "amount_vs_sender_avg",
    "amount_to_balance_ratio",
    "amount_band",
    "sender_unique_devices",
    "is_device_switch",
    "balance_drain_rate",
    "sender_balance_change",
    "balance_remaining_pct",
    "is_high_value_target",
    "bal_to_type_avg_ratio",
    "dist_from_nairobi",
    "is_outside_kenya",
    "device_unique_senders",
    "transaction_type_enc",
]
EXTENDED_SCALED = [c for c in EXTENDED if c not in [*NOT_SCALED, "amount_band", "is_high_value_target"]]
DROPPED_LATER = ["is_high_value", "amount_band", "sender_balance_change", "is_high_value_target"]
AMOUNT_BANDS = 8


def with_profiles(tx: DataFrame, profiles: Profiles) -> DataFrame:
    """Join the stored profiles and fill what an unseen sender or device lacks.

    Neither side is hinted: profiles grow with the senders, so their stored size decides between a broadcast and a
    shuffled join, and a hot sender is split at run time since it repeats on the transaction side only. The
    fallbacks come in as a scalar subquery, not as a join.
    """
    sender = profiles.sender.select(
        "sender_id",
        F.col("total_tx").alias("_total_tx"),
        F.col("unique_recv").alias("_unique_recv"),
        F.col("unique_devices").alias("_unique_devices"),
        F.col("avg_amount").alias("_avg_amount"),
        F.col("primary_device").alias("_primary_device"),
    )
    device = profiles.device.select("device_id", F.col("unique_senders").alias("_unique_senders"))
    joined = tx.join(sender, "sender_id", "left").join(device, "device_id", "left")
    filled = joined.withColumn("_fallback", one_row(profiles.fallbacks))

    def stored(name: str):
        return F.coalesce(F.col(f"_{name}"), F.col(f"_fallback.{name}"))

    switched = F.when(F.col("_primary_device").isNull(), F.col("_fallback.is_device_switch"))
    return filled.withColumns(
        {
            "sender_total_tx": stored("total_tx").cast("bigint"),
            "sender_unique_recv": stored("unique_recv").cast("bigint"),
            "sender_unique_devices": stored("unique_devices").cast("bigint"),
            "_sender_avg": stored("avg_amount"),
            "device_unique_senders": stored("unique_senders").cast("bigint"),
            "is_device_switch": switched.otherwise(
                flag(~F.col("device_id").eqNullSafe(F.col("_primary_device")))
            ),
        }
    )


def features(tx: DataFrame, profiles: Profiles, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of the input (those it has), then the features, not scaled."""
    joined = with_profiles(tx, profiles)
    derived = {
        **temporal_features(F.col("timestamp")),
        **amount_features(F.col("amount"), F.col("_sender_avg")),
        **balance_features(),
        **geographic_features(),
        "transaction_type_enc": type_code(F.col("transaction_type")),
    }
    kept = [c for c in (keep or []) if c in tx.columns]
    return joined.select(
        *kept, *[derived[name].alias(name) if name in derived else F.col(name) for name in FEATURES]
    )


@dataclass(frozen=True)
class Context:
    """What the exploratory features need of the training rows: band limits of the amount, balances of the types."""

    edges: DataFrame
    types: DataFrame


def fit_context(tx: DataFrame) -> Context:
    return Context(settled(band_edges(tx, "amount", AMOUNT_BANDS)), type_balance(tx))


def extended_features(tx: DataFrame, profiles: Profiles, context: Context, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of the input (those it has), then the 22 features of the exploratory list, not scaled.

    Bands and type balances are those of the fitted rows, so a batch cannot move them. A type that was not fitted is
    no high-value target and has a ratio of 1; a null amount is in band -1.
    """
    placed = with_type_balance(tx, context.types).withColumn("_edges", context.edges.scalar())
    derived = {
        "amount_band": F.coalesce(band_of("amount", F.col("_edges")), F.lit(-1)),
        "balance_remaining_pct": balance_remaining_pct(),
        "is_high_value_target": F.coalesce("is_high_value_target", F.lit(0)),
        "bal_to_type_avg_ratio": F.coalesce("bal_to_type_avg_ratio", F.lit(1.0)),
    }
    more = placed.withColumns(derived).drop("_edges", "bal_to_type_mean")
    kept = [c for c in (keep or []) if c in tx.columns]
    return features(more, profiles, [*kept, *derived]).select(*kept, *EXTENDED)
