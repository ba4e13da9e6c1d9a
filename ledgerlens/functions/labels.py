"""Bands, tiers and label texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import flag

# Fixed values.
DECISION_THRESHOLD = 0.33
SUSPICIOUS_FROM = 0.30
FRAUD_FROM = 0.55
AGE_UPPER_EDGES = [0, 7, 30, 90, 180]
AGE_LABELS = ["Day 0 (First)", "1-7 days", "8-30 days", "31-90 days", "91-180 days", "180+ days"]


def predicted_fraud(score: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return flag(score >= F.lit(float(threshold)))


def risk_tier(score: Column, suspicious: float = SUSPICIOUS_FROM, fraud: float = FRAUD_FROM) -> Column:
    return (
        F.when(score >= F.lit(fraud), "fraud").when(score >= F.lit(suspicious), "suspicious").otherwise("legitimate")
    )


def right_closed_band(value: Column, upper_edges: list[float], labels: list[str]) -> Column:
    """The first label whose upper edge is not below the value; the last label is open above."""
    chain = F.when(value <= F.lit(upper_edges[0]), labels[0])
    for edge, label in zip(upper_edges[1:], labels[1:]):
        chain = chain.when(value <= F.lit(edge), label)
    return chain.when(value.isNotNull(), labels[len(upper_edges)])


def age_bucket(days: Column) -> Column:
    return right_closed_band(F.when(days >= 0, days), AGE_UPPER_EDGES, AGE_LABELS)


def class_label(is_fraud: Column) -> Column:
    return F.when(is_fraud == 1, "Fraud").when(is_fraud == 0, "Legitimate")


def region_label(is_outside: Column) -> Column:
    return F.when(is_outside == 1, "Outside Kenya").when(is_outside == 0, "Inside Kenya")


def range_label(low: Column, high: Column) -> Column:
    """``1,234-5,678``: whole parts with thousands separators."""
    return F.concat(F.format_number(low.cast("bigint"), 0), F.lit("-"), F.format_number(high.cast("bigint"), 0))
