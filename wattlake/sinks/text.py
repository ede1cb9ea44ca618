"""Text exports (B3 full view export, B4 bounded export with header)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_text(df: DataFrame, path: str, sep: str = ",", compression: str = "gzip") -> None:
    """Whole result as delimited text without header, written in parallel
    (one file per task).  NULL is written as an empty field."""
    (df.write.mode("overwrite").option("header", False).option("sep", sep)
       .option("compression", compression).csv(path))


def export_bounded_csv(df: DataFrame, path: str) -> None:
    """A bounded result (already limited) as a single CSV file with header.

    ``coalesce(1)`` is safe only because callers pass a limited frame; the
    ordered limit has already gathered at most ``n`` rows.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
