"""Writing report-sized results to files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(report: DataFrame, folder: str) -> None:
    """CSV parts with a header; a sorted report keeps its order across the parts."""
    report.write.mode("errorifexists").option("header", True).csv(folder)


def write_json(report: DataFrame, folder: str) -> None:
    """One JSON object per row, NULL fields included."""
    report.write.mode("errorifexists").option("ignoreNullFields", False).json(folder)
