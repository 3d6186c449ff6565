"""Derived listing columns: identity, price bands, price per square metre."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_FIELDS = (
    "origem", "tipo", "localizacao", "area", "quartos", "banheiros", "vagas", "preco",
)


def listing_id(*fields: Column) -> Column:
    """SHA-256 of the fields joined without a separator; NULL if any field is NULL."""
    return F.sha2(F.concat(*[field.cast("string") for field in fields]), 256)


@dataclass(frozen=True)
class Band:
    """A price range: closed at `low` and `high`, open at `above`."""

    label: str
    low: int | None = None
    high: int | None = None
    above: int | None = None

    def holds(self, price: Column) -> Column:
        if self.above is not None:
            return price > self.above
        if self.low is None:
            return price <= self.high
        return price.between(self.low, self.high)


# Band edges of the listing label.
BANDS = (
    Band("1", high=200_000),
    Band("2", low=200_001, high=500_000),
    Band("3", low=500_001, high=1_000_000),
    Band("4", low=1_000_001, high=5_000_000),
    Band("5", above=5_000_000),
)

# The marts count the top band from a different edge than the label does.
MART_BANDS = (*BANDS[:-1], replace(BANDS[-1], above=5_000_001))


def price_band(price: Column, bands: Sequence[Band] = BANDS) -> Column:
    """Label of the first band that holds the price; NULL in the gaps between bands."""
    return F.coalesce(*[F.when(band.holds(price), F.lit(band.label)) for band in bands])


def band_counts(
    price: Column, bands: Sequence[Band] = MART_BANDS, weight: Column | None = None
) -> list[Column]:
    """One conditional count per band, named faixa_<label>.

    With `weight`, rows stand for that many listings each.
    """
    if weight is None:
        weight = F.lit(1)
    return [
        F.coalesce(F.sum(F.when(band.holds(price), weight)), F.lit(0))
        .cast("bigint")
        .alias(f"faixa_{band.label}")
        for band in bands
    ]


def price_per_m2(price: Column, area: Column) -> Column:
    """Single precision, as the price is; NULL for a zero area."""
    return F.try_divide(price, area).cast("float")
