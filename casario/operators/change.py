"""Change of a series from one period to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casario.functions import percent_change, round_half_away


def previous(column: str, by: Sequence[str], order: str = "date_ref") -> Column:
    """Value of the row before within the series; NULL on the first."""
    return F.lag(column, 1).over(Window.partitionBy(*by).orderBy(order))


def change_or_zero(column: str, by: Sequence[str], order: str = "date_ref") -> Column:
    """Percent change against the row before in single precision; 0 on the first row."""
    before = previous(column, by, order)
    change = round_half_away(percent_change(F.col(column), before, "float"))
    return F.when(before.isNotNull(), change).otherwise(F.lit(0)).cast("float")


def series_change(series: DataFrame, column: str, order: str = "date_ref") -> DataFrame:
    """Add `variacao_pct` to a series with one row per period.

    The series is an aggregate, as long as there are periods, so ordering it in one
    partition is cheap.
    """
    before = previous(column, [F.lit(0)], order)
    change = percent_change(F.col(column).cast("double"), before.cast("double"))
    return series.withColumn("variacao_pct", round_half_away(change))
