"""Row filters of the warehouse and of the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What counts as a plausible listing.
PRICE_ABOVE = 65_000
RANGES = {
    "quartos": (1, 10),
    "banheiros": (1, 10),
    "vagas": (1, 10),
    "area": (30, 1000),
}

# Fixed value: the choice that means "no filter".
ALL = "Todos"


def plausible(
    df: DataFrame,
    price_above: float = PRICE_ABOVE,
    ranges: Mapping[str, tuple[int, int]] = RANGES,
) -> DataFrame:
    """Rows with a price above the limit and every count or size in its closed range."""
    test = F.col("preco") > price_above
    for name, (low, high) in ranges.items():
        test = test & F.col(name).between(low, high)
    return df.where(test)


def filter_listings(
    df: DataFrame,
    tipo: str | None = None,
    locations: Sequence[str] | None = None,
    region: str | None = None,
    price_min: float | None = None,
    price_max: float | None = None,
) -> DataFrame:
    """The report filters; None, 'Todos' or an empty list leave a column unfiltered.

    The region filter is skipped when the table has no region column.
    """
    if tipo not in (None, ALL):
        df = df.where(F.col("tipo") == tipo)
    if locations:
        df = df.where(F.col("localizacao").isin(list(locations)))
    if price_min is not None:
        df = df.where(F.col("preco") >= price_min)
    if price_max is not None:
        df = df.where(F.col("preco") <= price_max)
    if region not in (None, ALL) and "secretaria_regional" in df.columns:
        df = df.where(F.col("secretaria_regional") == region)
    return df
