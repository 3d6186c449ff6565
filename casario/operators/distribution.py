"""Exact group statistics that never need a whole group in one task.

Spark's own exact median keeps a map of all distinct values of a group in one task,
which a very large group outgrows.  Here a group is first reduced to value counts,
spread over the cluster by value.  Ranks are found on coarse bins of those counts, and
only the bins that hold a wanted rank are sorted.

Values are single precision, as listing prices are: that bounds a bin to about 23
thousand distinct values however many listings there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casario.functions.numeric import whole_part

BINS_PER_OCTAVE = 512
_ABOVE_LOWEST_BIN = 200 * BINS_PER_OCTAVE
_LARGEST_FLOAT = 3.4028234e38


def value_counts(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """How often each combination of the measures' values occurs per group.

    One row per group and combination: keys, a column per measure, `n`.  All statistics of a group
    follow from these rows; they are fewer than the listings, and shuffled once.
    """
    values = [column.cast("float").alias(name) for name, column in measures.items()]
    return df.select(*keys, *values).groupBy(*keys, *measures).agg(F.count(F.lit(1)).alias("n"))


def _by_measure(counts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A row per measure of each row of `value_counts`: keys, `measure`, `value`, `n`."""
    if len(measures) == 1:
        return counts.select(*keys, F.lit(measures[0]).alias("measure"), F.col(measures[0]).alias("value"), "n")
    cells = [cell for name in measures for cell in (F.lit(name), F.col(name))]
    return counts.select(*keys, "n", F.stack(F.lit(len(measures)), *cells).alias("measure", "value"))


def _bin(value: Column) -> Column:
    """A coarse bin number that grows with the value."""
    size = F.abs(value).cast("double")
    octave = F.log2(F.least(size, F.lit(_LARGEST_FLOAT)))
    step = F.floor(octave * BINS_PER_OCTAVE).cast("int") + _ABOVE_LOWEST_BIN
    return F.when(value > 0, step).when(value < 0, -step).otherwise(0)


def _usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def quantiles(
    counts: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]]
) -> DataFrame:
    """Exact quantiles with linear interpolation, from the rows of `value_counts`.

    `wanted` maps an output column to its measure and probability.  NULL and NaN values
    are left out.  One row per group, in double precision.
    """
    group = [*keys, "measure"]
    probs = sorted({p for _, p in wanted.values()})

    # Rows without a value weigh nothing instead of being filtered out: a filter would
    # be pushed below the value counts and cost a second pass over the listings.
    long = _by_measure(counts, keys, sorted({measure for measure, _ in wanted.values()}))
    weighed = long.withColumn(
        "n", F.when(_usable(F.col("value")), F.col("n")).otherwise(F.lit(0))
    ).withColumn("bin", _bin(F.col("value")))

    bins = weighed.groupBy(*group, "bin").agg(F.sum("n").alias("in_bin"))
    rising = Window.partitionBy(*group).orderBy("bin")
    placed = bins.select(
        *group,
        "bin",
        (F.sum("in_bin").over(rising) - F.col("in_bin")).alias("before"),
        F.sum("in_bin").over(rising).alias("upto"),
        F.sum("in_bin").over(Window.partitionBy(*group)).alias("total"),
    )
    rank = lambda p: (F.col("total") - 1) * F.lit(p)
    lower = lambda p: F.floor(rank(p))
    upper = lambda p: F.ceil(rank(p))
    covers = lambda r: (r >= F.col("before")) & (r < F.col("upto"))
    any_rank = reduce(
        lambda a, b: a | b, [covers(r(p)) for p in probs for r in (lower, upper)]
    )
    hit = placed.where(any_rank).select(
        *[F.col(name).alias(f"hit_{name}") for name in [*group, "bin"]], "before", "total"
    )

    same_bin = reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.col(f"hit_{name}")) for name in [*group, "bin"]],
    )
    # Hits are a few rows per group, so they are the side to hash; no sort is needed, and
    # nothing is broadcast, whatever the number of groups.
    inside = weighed.join(hit.hint("shuffle_hash"), same_bin).select(
        *group, "bin", "value", "n", "before", "total"
    )
    # A value can be in several rows; each has ranks of its own.
    rising_inside = Window.partitionBy(*group, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn(
        "upto", F.col("before") + F.sum("n").over(rising_inside)
    ).withColumn("before", F.col("upto") - F.col("n"))

    picks, results = [], []
    for name, (measure, p) in wanted.items():
        here = F.col("measure") == measure
        low, high, part = f"_{name}_low", f"_{name}_high", f"_{name}_part"
        picks += [
            F.max(F.when(here & covers(lower(p)), F.col("value"))).alias(low),
            F.max(F.when(here & covers(upper(p)), F.col("value"))).alias(high),
            F.max(F.when(here, rank(p) - lower(p))).alias(part),
        ]
        gap = F.col(high).cast("double") - F.col(low).cast("double")
        step = F.when(F.col(part) > 0, gap * F.col(part)).otherwise(F.lit(0.0))
        results.append((F.col(low).cast("double") + step).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)


def merge_groups(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Put frames with one row per group side by side.

    Done by union and grouping, so NULL keys meet, and a grand total (no keys) needs no
    cross join.
    """
    names = [name for frame in frames for name in frame.columns if name not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in names]
    )


def mean(measure: str) -> Column:
    """Mean of a measure over the rows of `value_counts`."""
    value = F.col(measure)
    total = F.sum(value.cast("double") * F.col("n"))
    return F.try_divide(total, F.sum(F.when(value.isNotNull(), F.col("n"))))


def medians(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Exact median of each measure per group, in columns of the same names."""
    counts = value_counts(df, keys, measures)
    return quantiles(counts, keys, {name: (name, 0.5) for name in measures})


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per category and their part of the total; NULL is no category."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", (F.col("n") / total).alias("share"))


def histogram(df: DataFrame, value: str, width: float, series: str) -> DataFrame:
    """Equal-width bins per series, with each bin's part of its series in percent."""
    start = whole_part(F.col(value).cast("double") / F.lit(float(width))) * F.lit(float(width))
    binned = (
        df.where(F.col(series).isNotNull() & F.col(value).isNotNull())
        .groupBy(series, start.alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    in_series = F.sum("n").over(Window.partitionBy(series))
    return binned.select(series, "bin_start", "n", (F.col("n") * 100.0 / in_series).alias("pct"))


def sum_by(df: DataFrame, x: str, y: str) -> DataFrame:
    """Sum of y per x, as bars with both axes given show it."""
    kept = df.where(F.col(x).isNotNull())
    return kept.groupBy(x).agg(F.sum(F.col(y).cast("double")).alias("total"))
