"""A transaction table laid over the ``events`` and ``customer`` tables.

There is no public mobile-money table at hand, so each event plays a transaction. Every derived column is a
deterministic expression over the two tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import flag

# Event type -> transaction type; any other event type is a deposit.
TYPE_OF_EVENT = {"view": "send_money", "click": "pay_bill", "purchase": "buy_goods", "error": "withdraw"}


def _columns() -> dict[str, Column]:
    event, value = F.col("event_id"), F.col("value")
    amount = value * 100
    before = F.col("c_acctbal") + 1000 + (event % 50) * 1000
    received = ((event * 31) % 5000).cast("double")
    kind = F.lit("deposit")
    for source, target in TYPE_OF_EVENT.items():
        kind = F.when(F.col("event_type") == source, target).otherwise(kind)
    return {
        "transaction_id": event.cast("string"),
        "timestamp": F.col("ts").cast("timestamp_ntz"),
        "sender_id": F.concat(F.lit("S"), F.col("user_id").cast("string")),
        "receiver_id": F.concat(F.lit("R"), ((event * 7919) % 97).cast("string")),
        "amount": amount,
        "transaction_type": kind,
        "sender_balance_before": before,
        "sender_balance_after": before - amount + F.when(event % 20 == 0, 5).otherwise(0),
        "receiver_balance_before": received,
        "receiver_balance_after": received + amount,
        "device_id": F.concat(F.lit("D"), F.get_json_object("props", "$.k")),
        "location_lat": ((event * 13) % 1100).cast("double") / 100 - 5.5,
        "location_lon": ((event * 17) % 900).cast("double") / 100 + 33.5,
        "is_fraud": flag((value > 150) | ((F.hour("ts") < 6) & (event % 10 == 0))),
    }


_NEEDS_CUSTOMER = {"sender_balance_before", "sender_balance_after"}


def transactions_from(events: DataFrame, customer: DataFrame, *columns: str) -> DataFrame:
    """The named transaction columns (all, if none are named) of ``events`` (a batch or a stream).

    ``customer`` is keyed by ``c_custkey``, so it is joined only where a sender balance is asked for. The join side
    is left to the optimizer: it broadcasts a small customer table and splits hot users of a large one.
    """
    exprs = _columns()
    wanted = columns or tuple(exprs)
    base = events
    if _NEEDS_CUSTOMER & set(wanted):
        balances = customer.select("c_custkey", "c_acctbal")
        base = events.join(balances, F.col("user_id") == F.col("c_custkey"), "left")
    return base.select(*[exprs[name].alias(name) for name in wanted])


def transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return transactions_from(events, customer, *columns)


def formula_score(amount: Column) -> Column:
    """A score for metric queries that needs no model; three decimals, so scores tie."""
    return F.round(1 / (1 + F.exp(-(amount / 10000 - 1.5))), 3)


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "amount", "is_fraud")
    return tx.select("transaction_id", "is_fraud", formula_score(F.col("amount")).alias("score"))


def blemished_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole transaction table with faults laid over it by event number, for the cleaning and validation queries.

    Non-finite and negative amounts, NULL devices, unknown types and labels, impossible latitudes, repeated rows, and
    three columns without information.
    """
    tx = transactions(spark, sf_dir)
    number = F.col("transaction_id").cast("bigint")

    def every(n: int) -> Column:
        return number % n == 0

    amount = (
        F.when(every(29), -F.col("amount"))
        .when(every(11), F.lit(float("nan")))
        .when(every(13), F.lit(float("inf")))
        .when(every(17), F.lit(float("-inf")))
        .when(~every(19), F.col("amount"))
    )
    faulty = tx.withColumns(
        {
            "amount": amount,
            "transaction_type": F.when(every(23), "airtime").otherwise(F.col("transaction_type")),
            "device_id": F.when(~every(43), F.col("device_id")),
            "location_lat": F.when(every(31), F.lit(95.0)).otherwise(F.col("location_lat")),
            "is_fraud": F.when(every(37), F.lit(2)).otherwise(F.col("is_fraud")),
            "currency": F.lit("KES"),
            "channel": F.lit(None).cast("string"),
            "fee": F.lit(1.5),
        }
    )
    return faulty.unionByName(faulty.where(every(41)))
