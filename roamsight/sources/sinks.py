"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_summary_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header, every field quoted and NULL as an empty field. For results of a few rows only."""
    (
        df.coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Parquet for session- and user-level tables; as many files as the last stage has tasks."""
    df.write.mode("overwrite").parquet(path)
