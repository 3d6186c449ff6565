"""Data-quality checks: each returns the violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that occur more than once, with their counts.

    NULLs do not count.
    """
    known = df.na.drop(subset=list(columns)).groupBy(*columns)
    return known.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that lack a value."""
    return df.where(F.col(column).isNull())
