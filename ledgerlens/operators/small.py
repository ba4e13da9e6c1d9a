"""Joins with small tables, and one-row tables as columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a summary table once, and mark it for broadcast only if it was counted to be small.

    Spark sizes an aggregate by its input, so it would shuffle the fact table to join a five-row summary. Here the
    summary is written to the checkpoint folder and counted; up to ``max_rows`` it is broadcast, beyond that the
    join is left to the optimizer as an ordinary shuffled join.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.checkpoint()
    return F.broadcast(kept) if kept.count() <= max_rows else kept


def settled(df: DataFrame) -> DataFrame:
    """Write a table that several plans read, and read it back.

    It goes to the shared checkpoint folder, so it outlives any executor, and its file size tells the optimizer
    whether it may be broadcast.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame) -> Column:
    """A one-row table as a struct column (an uncorrelated scalar subquery), to be used in another table's select."""
    return df.select(F.struct("*").alias("row")).scalar()


def any_null(columns: list[str]) -> Column:
    """True where at least one of the columns is NULL."""
    out = F.lit(False)
    for name in columns:
        out = out | F.col(name).isNull()
    return out
