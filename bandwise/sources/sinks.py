"""Report sink (S4): reports are DataFrames; the caller picks show() or a write."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by=None) -> None:
    """Write a report or scored table to shared storage (parquet, csv, json, ...)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
