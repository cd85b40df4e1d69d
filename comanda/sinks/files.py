"""File sinks: graph CSVs, route JSON, search documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comanda.sinks.tables import counted


def write_csv(df: DataFrame, path: str) -> int:
    """CSV with header; NULL is an empty field."""
    df, rows = counted(df)
    df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return rows.get["rows"]


def write_json(df: DataFrame, path: str) -> int:
    """One JSON object per row; nested lists stay nested."""
    df, rows = counted(df)
    df.write.mode("overwrite").json(path)
    return rows.get["rows"]


def write_parquet(df: DataFrame, path: str) -> int:
    df, rows = counted(df)
    df.write.mode("overwrite").parquet(path)
    return rows.get["rows"]
