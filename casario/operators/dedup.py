"""Keep one row per key, and stack month snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "_position"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key group in the given order; NULL keys form one group.

    The row_number filter lets Spark keep one row per key in each map task before it
    shuffles (WindowGroupLimit), so a key that holds a large part of the table costs
    one row per task.  Name the most selective key first: it leads the sort prefix.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn(_POSITION, F.row_number().over(by_key))
    return numbered.where(F.col(_POSITION) == 1).drop(_POSITION)


def total_order(df: DataFrame, lead: Sequence[Column], skip: Sequence[str] = ()) -> list[Column]:
    """`lead`, then every other column ascending with NULLs last, so that ties between
    unequal rows are always broken the same way."""
    rest = [F.col(name).asc_nulls_last() for name in df.columns if name not in skip]
    return [*lead, *rest]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column that one of them lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
