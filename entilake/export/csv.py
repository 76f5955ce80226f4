"""CSV results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One CSV file with a header, in order if one is given. For results of one row per day or type, not per record."""
    out = df.coalesce(1)
    (out.sortWithinPartitions(*order) if order else out).write.mode("overwrite").csv(path, header=True)


def write_csv_parts(df: DataFrame, path: str) -> None:
    """CSV files as many as there are partitions, each with a header: for results of one row per user or entity."""
    df.write.mode("overwrite").csv(path, header=True)
