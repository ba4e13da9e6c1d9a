"""Fitted state on disk: profiles, fallbacks, scaler, model, baseline."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.profiles import (
    Profiles,
    device_pairs,
    device_profile,
    profile_fallbacks,
    receiver_pairs,
    sender_profile,
)
from ledgerlens.operators.scaling import Scaler

MIN_EXPORT_AUC = 0.95


def save_profiles(profiles: Profiles, path: str) -> None:
    profiles.sender.write.mode("overwrite").parquet(f"{path}/sender")
    profiles.device.write.mode("overwrite").parquet(f"{path}/device")
    profiles.fallbacks.write.mode("overwrite").parquet(f"{path}/fallbacks")


def load_profiles(spark: SparkSession, path: str) -> Profiles:
    return Profiles(*[spark.read.parquet(f"{path}/{name}") for name in ("sender", "device", "fallbacks")])


def fit_and_save_profiles(tx: DataFrame, path: str) -> Profiles:
    """Write the pair tables first; everything else is derived from them, so the fact table is aggregated once."""
    spark = tx.sparkSession
    device_pairs(tx).write.mode("overwrite").parquet(f"{path}/device_pairs")
    receiver_pairs(tx).write.mode("overwrite").parquet(f"{path}/receiver_pairs")
    pairs = spark.read.parquet(f"{path}/device_pairs")
    receivers = spark.read.parquet(f"{path}/receiver_pairs")
    sender_profile(pairs, receivers).write.mode("overwrite").parquet(f"{path}/sender")
    device_profile(pairs).write.mode("overwrite").parquet(f"{path}/device")
    profile_fallbacks(spark.read.parquet(f"{path}/sender")).write.mode("overwrite").parquet(f"{path}/fallbacks")
    return load_profiles(spark, path)


def save_scaler(scaler: Scaler, path: str) -> None:
    scaler.table().write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> Scaler:
    """The stored scaler has one row a feature; its names come to the driver, its values stay a one-row table."""
    table = spark.read.parquet(path)
    columns = [r["column"] for r in table.select("column").collect()]
    picks = []
    for part, prefix in (("mean", "mean_"), ("scale", "scale_")):
        picks += [F.max(F.when(F.col("column") == c, F.col(part))).alias(f"{prefix}{c}") for c in columns]
    return Scaler(columns, table.agg(*picks))


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def export_gate(metrics: DataFrame, minimum: float = MIN_EXPORT_AUC) -> DataFrame:
    """``(roc_auc, minimum, may_export)`` of a one-row metric table."""
    return metrics.select("roc_auc", F.lit(minimum).alias("minimum"), (F.col("roc_auc") >= minimum).alias("may_export"))


def export_model(
    model: PipelineModel, profiles_path: str, scaler: Scaler, metrics: DataFrame, out_dir: str, version: str,
    minimum: float = MIN_EXPORT_AUC,
) -> str:
    """Write model, profiles, scaler and metadata as one versioned bundle; refuse if the ROC area is too low."""
    gate = export_gate(metrics, minimum).first()
    if gate is None or not gate["may_export"]:
        raise ValueError(f"ROC area {gate and gate['roc_auc']} is below the export minimum {minimum}")
    spark = metrics.sparkSession
    path = f"{out_dir}/v_{version}"
    model.write().overwrite().save(f"{path}/model")
    save_profiles(load_profiles(spark, profiles_path), f"{path}/profiles")
    save_scaler(scaler, f"{path}/scaler")
    metadata = metrics.select(
        F.lit(version).alias("model_version"), F.lit(type(model.stages[-1]).__name__).alias("model_type"), "*",
        F.lit(0.30).alias("suspicious_from"), F.lit(0.55).alias("fraud_from"),
    )
    metadata.write.mode("overwrite").json(f"{path}/metadata")
    return path
