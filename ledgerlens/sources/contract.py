"""The transaction contract: columns, types and allowed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One column of the contract with its constraints."""

    column: str
    kind: str
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple | None = None


# The contract, in its order.
TRANSACTION_RULES = [
    Rule("transaction_id", "string"),
    Rule("timestamp", "string"),
    Rule("sender_id", "string"),
    Rule("receiver_id", "string"),
    Rule("amount", "float", minimum=0.0),
    Rule("transaction_type", "string", allowed=("buy_goods", "deposit", "send_money", "withdraw", "pay_bill")),
    Rule("sender_balance_before", "float", minimum=0.0),
    Rule("sender_balance_after", "float", minimum=-1584.0),
    Rule("receiver_balance_before", "float", minimum=0.0),
    Rule("receiver_balance_after", "float", minimum=0.0),
    Rule("device_id", "string"),
    Rule("location_lat", "float", minimum=-90.0, maximum=90.0),
    Rule("location_lon", "float", minimum=-180.0, maximum=180.0),
    Rule("is_fraud", "integer", allowed=(0, 1)),
]
LABEL = "is_fraud"
SCORING_COLUMNS = [rule.column for rule in TRANSACTION_RULES if rule.column != LABEL]
ID_COLUMNS = ["transaction_id", "timestamp", "sender_id", "receiver_id", "amount", "transaction_type"]
NUMERIC_COLUMNS = [
    "amount",
    "sender_balance_before",
    "sender_balance_after",
    "receiver_balance_before",
    "receiver_balance_after",
]

# Spark types that satisfy each contract type. Times count as text: the contract keeps them unparsed.
ACCEPTED = {
    "string": (T.StringType, T.VarcharType, T.CharType),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "number": (T.FloatType, T.DoubleType),
    "boolean": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}
_DECLARED = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "float": T.DoubleType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
}


def declared_schema(rules: list[Rule] = TRANSACTION_RULES, label: bool = True) -> T.StructType:
    """The schema to read with, so no file is scanned twice to guess types."""
    return T.StructType(
        [T.StructField(r.column, _DECLARED[r.kind]) for r in rules if label or r.column != LABEL]
    )
