"""Sinks: tables, one-row JSON summaries, models.

Writes are whole-directory, overwrite-mode Spark writes (atomic per job
commit), so a retried job after an executor loss simply rewrites its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Feature / breakdown table sink (A7): Parquet by default, CSV with a header on request."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_summary(df: DataFrame, path: str) -> str:
    """One-row (possibly nested) summary as JSON (A8); the row count is bounded by construction."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def save_model(model, path: str) -> str:
    """Model directory (A11): Spark ML pipeline + preprocessing statistics."""
    model.save(path)
    return path
