"""Artefact sinks: fitted statistics and models saved under a path, loaded back (SNK1, SNK2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_stats(stats: DataFrame, path: str) -> str:
    """Fitted scaler statistics as parquet (the directory is created)."""
    stats.write.mode("overwrite").parquet(path)
    return path


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> str:
    """An MLlib model or pipeline model, overwriting ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(cls, path: str):
    return cls.load(path)
