"""Amount and balance columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import clipped, flag, ratio

# Fixed values.
HIGH_VALUE_ABOVE = 10_000.0
DISCREPANCY_ABOVE = 1.0
TYPE_CODES = {"send_money": 0, "pay_bill": 1, "buy_goods": 2, "withdraw": 3, "deposit": 4}
UNKNOWN_TYPE_CODE = -1


def amount_features(amount: Column, sender_avg: Column) -> dict[str, Column]:
    """``sender_avg`` comes from the stored profile, so it is an argument here."""
    return {
        "log_amount": F.log1p(amount),
        "is_high_value": flag(amount > HIGH_VALUE_ABOVE),
        "amount_vs_sender_avg": ratio(amount, sender_avg + F.lit(1.0)),
    }


def balance_features() -> dict[str, Column]:
    before, after = F.col("sender_balance_before"), F.col("sender_balance_after")
    sender_change = before - after
    spent = ratio(F.col("amount"), before + F.lit(1.0))
    return {
        "balance_drain_rate": clipped(spent, F.lit(0.0), F.lit(1.0)),
        "sender_balance_change": sender_change,
        "receiver_balance_change": F.col("receiver_balance_after") - F.col("receiver_balance_before"),
        "balance_discrepancy": flag(F.abs(sender_change - F.col("amount")) > DISCREPANCY_ABOVE),
        "amount_to_balance_ratio": spent,
    }


def balance_remaining_pct() -> Column:
    return ratio(F.col("sender_balance_after"), F.col("sender_balance_before") + F.lit(1.0)) * F.lit(100.0)


def type_code(kind: Column) -> Column:
    """The fixed code of a transaction type. A frequency-ordered indexer would move between fits."""
    pairs = [F.lit(part) for pair in TYPE_CODES.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(UNKNOWN_TYPE_CODE))
