"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table `name` of `folder`; only `columns`, if given, reach the scan."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def current_rows(df: DataFrame, key: str, rev: str, *columns: str) -> DataFrame:
    """One row per `key`: that of the highest `rev`. Exact repeats and ties end in the row with the greatest remaining
    columns, so the result does not depend on order. Rows without a key are dropped; a NULL rev ranks lowest.

    max() over a struct combines on the map side, so a key that holds a third of all rows sends one row per task."""
    rest = list(columns) or [c for c in df.columns if c not in (key, rev)]
    best = F.max(F.struct(F.col(rev), *[F.col(c) for c in rest])).alias("_best")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, f"_best.{rev}", *[f"_best.{c}" for c in rest])
