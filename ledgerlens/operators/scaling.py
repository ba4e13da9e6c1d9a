"""Standardisation with the population deviation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.small import one_row


@dataclass(frozen=True)
class Scaler:
    """The scaled columns and a one-row table with ``mean_<column>`` and ``scale_<column>``."""

    columns: list[str]
    params: DataFrame

    def table(self) -> DataFrame:
        """One row a column: ``(column, mean, scale)``."""
        entries = [
            F.struct(
                F.lit(c).alias("column"), F.col(f"mean_{c}").alias("mean"), F.col(f"scale_{c}").alias("scale")
            )
            for c in self.columns
        ]
        return self.params.select(F.inline(F.array(*entries)))


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population deviation of each column, from one pass. A column without spread is scaled by 1."""
    means = [F.avg(c).alias(f"mean_{c}") for c in columns]
    spreads = [
        F.when(F.min(c) == F.max(c), F.lit(1.0)).otherwise(F.stddev_pop(c)).alias(f"scale_{c}") for c in columns
    ]
    return Scaler(list(columns), df.agg(*means, *spreads))


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Centre and scale the fitted columns; the others pass unchanged. The parameters are a scalar subquery."""
    scaled = {c: (F.col(c) - F.col(f"_p.mean_{c}")) / F.col(f"_p.scale_{c}") for c in scaler.columns}
    return df.withColumn("_p", one_row(scaler.params)).withColumns(scaled).drop("_p")
