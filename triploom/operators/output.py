"""Output shapes: metric rows as JSON objects, scalars as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_json_rows(df: DataFrame, col: str = "json") -> DataFrame:
    """One JSON object per row, keys in column order (``{"region": ..., ...}``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(col))


def scalar_text(df: DataFrame, col: str) -> DataFrame:
    """The single value of a one-row metric as text, as the result edge shows it."""
    return df.select(F.col(col).cast("string").alias(col))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metric rows as JSON lines files."""
    df.write.mode(mode).json(path)
