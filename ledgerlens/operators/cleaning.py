"""Cleaning: constant columns, non-finite numbers, nulls, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.numeric import finite, flag
from ledgerlens.sources.contract import TRANSACTION_RULES
from ledgerlens.sources.files import SourceError

CONTRACT_COLUMNS = tuple(rule.column for rule in TRANSACTION_RULES)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_constancy(df: DataFrame) -> DataFrame:
    """One row a column: is it constant, has it zero variance, is it all NULL. One pass over the table.

    A column is constant if its least and greatest non-null values agree; an all-null column has neither, so it is
    not constant. Zero variance is asked of numeric columns with two values or more; equal extremes count as zero,
    since merging partial variances can leave a rounding residue.
    """
    numeric = set(numeric_columns(df))
    aggregates = []
    for c in df.columns:
        aggregates += [
            F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias(f"{c}|constant"),
            (F.count(c) == 0).alias(f"{c}|empty"),
            (
                F.coalesce((F.count(c) > 1) & ((F.min(c) == F.max(c)) | (F.var_samp(c) == 0)), F.lit(False))
                if c in numeric
                else F.lit(False)
            ).alias(f"{c}|flat"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            flag(F.col(f"{c}|constant")).alias("is_constant"),
            flag(F.col(f"{c}|flat")).alias("is_zero_variance"),
            flag(F.col(f"{c}|empty")).alias("is_all_null"),
        )
        for c in df.columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def drop_constant_columns(df: DataFrame, keep: tuple[str, ...] = CONTRACT_COLUMNS) -> DataFrame:
    """Drop constant and zero-variance columns, but none of ``keep``: a later contract check needs those.

    ``keep=()`` drops every constant column. The result of the one pass is one row a column.
    """
    found = column_constancy(df).where("is_constant = 1 or is_zero_variance = 1").collect()
    return df.drop(*[row["column"] for row in found if row["column"] not in keep])


def null_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities of floating columns become NULL, so every later operator sees one missing value."""
    kinds = (T.FloatType, T.DoubleType)
    return df.select(
        *[finite(F.col(f.name)).alias(f.name) if isinstance(f.dataType, kinds) else f.name for f in df.schema.fields]
    )


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Read the columns as numbers; a text that is none becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls of every column, one row a column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counts.select(F.inline(F.array(*entries)))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key. Grouped by key, so the shuffle carries a key and a count only."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def integrity_probes(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Balance conservation, signs and self-transfers: ``(probe, violations, fraud_rate)``, one pass."""
    sent = F.col("sender_balance_before") - F.col("amount") - F.col("sender_balance_after")
    got = F.col("receiver_balance_after") - F.col("receiver_balance_before") - F.col("amount")
    probes = {
        "sender_balance": F.abs(sent) > tolerance,
        "receiver_balance": F.abs(got) > tolerance,
        "negative_sender_before": F.col("sender_balance_before") < 0,
        "negative_sender_after": F.col("sender_balance_after") < 0,
        "non_positive_amount": F.col("amount") <= 0,
        "self_transfer": F.col("sender_id") == F.col("receiver_id"),
    }
    aggregates = []
    for name, broken in probes.items():
        aggregates += [
            F.count_if(broken).alias(name),
            F.avg(F.when(broken, F.col("is_fraud").cast("double"))).alias(f"{name}|rate"),
        ]
    entries = [
        F.struct(
            F.lit(n).alias("probe"), F.col(n).alias("violations"), F.round(f"{n}|rate", 6).alias("fraud_rate")
        )
        for n in probes
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def clean(df: DataFrame, keep: tuple[str, ...] = CONTRACT_COLUMNS) -> DataFrame:
    """Constant columns out, non-finite to NULL, rows with a NULL out.

    An all-null column would take every row with it, so it is named in an error instead.
    """
    empty = [r["column"] for r in column_constancy(df).where("is_all_null = 1").collect()]
    if empty and not df.isEmpty():
        raise SourceError(f"columns without any value: {empty}")
    return drop_null_rows(null_nonfinite(drop_constant_columns(df, keep)))


def align_columns(df: DataFrame, columns: list[str], fill: float = 0.0) -> DataFrame:
    """Exactly ``columns``, in order; an absent one is filled."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def pass_through(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of ``columns`` the table has."""
    return [c for c in columns if c in df.columns]
