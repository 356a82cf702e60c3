"""Tab-separated reports of a handful of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str) -> None:
    """One headed file under ``path``; NULL is written as NULL."""
    report.coalesce(1).write.mode("overwrite").csv(
        path, sep="\t", header=True, nullValue="NULL", emptyValue=""
    )
