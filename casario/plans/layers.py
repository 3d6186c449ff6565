"""The warehouse layers as functions from frame to frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.functions import (
    BANDS,
    MART_BANDS,
    Band,
    band_counts,
    before_comma,
    listing_id,
    or_zero,
    price_band,
    price_digits,
    price_per_m2,
    round_half_away,
    try_int,
    try_real,
)
from casario.functions.features import ID_FIELDS
from casario.operators import (
    change_or_zero,
    enrich_location,
    keep_first,
    mean,
    merge_groups,
    plausible,
    quantiles,
    total_order,
    value_counts,
)
from casario.operators.filters import PRICE_ABOVE, RANGES
from casario.schema import AUDIT, BRONZE_COLUMNS, OBT, SILVER

#: Columns that become whole numbers, 0 where there is none.
COUNTS = ("area", "quartos", "banheiros", "vagas")

# Fixed value: groups with no more listings than this stay out of the marts.
MIN_LISTINGS = 20


def stamped(df: DataFrame) -> DataFrame:
    """Add the audit timestamp of the build."""
    return df.withColumn(AUDIT, F.current_timestamp())


def bronze(raw: DataFrame) -> DataFrame:
    """Names and order of the raw columns."""
    return raw.select(*BRONZE_COLUMNS)


def typed(listings: DataFrame) -> DataFrame:
    """Bronze text to silver types, with the listing's identity.

    The identity covers the price as cleaned text, so it is built before the cast.
    """
    cleaned = listings.select(
        "origem",
        "date_ref",
        "tipo",
        before_comma(F.col("localizacao")).alias("localizacao"),
        *[or_zero(try_int(F.col(name))).alias(name) for name in COUNTS],
        price_digits(F.col("preco")).alias("preco"),
        price_digits(F.col("condo")).alias("condo"),
    )
    amount = lambda name: or_zero(try_real(F.col(name))).cast("float")
    return cleaned.select(
        listing_id(*[F.col(name) for name in ID_FIELDS]).alias("id"),
        "origem", "date_ref", "tipo", "localizacao", *COUNTS,
        amount("preco").alias("preco"),
        amount("condo").alias("condo"),
    )


def has_identity() -> Column:
    """Whether a bronze row gets an identity, told from its raw columns, so that the test can
    reach the scan.

    Cleaning keeps NULLs as they are, but for the counts, which are never NULL afterwards.
    """
    named = [F.col(name).isNotNull() for name in ID_FIELDS if name not in COUNTS]
    return reduce(lambda a, b: a & b, named)


def dedup_month(listings: DataFrame, keys: Sequence[str] = ("id", "date_ref")) -> DataFrame:
    """One row per identity and month, the dearest first.

    Pass keys=("id",) for a frame that holds a single month.
    """
    return keep_first(listings, keys, total_order(listings, [F.col("preco").desc()], keys))


def dedup_all(listings: DataFrame) -> DataFrame:
    """One row per identity over all months; of equal prices the earliest month stays."""
    lead = [F.col("preco").desc(), F.col("date_ref").asc_nulls_last()]
    return keep_first(listings, ["id"], total_order(listings, lead, ["id", "preco", "date_ref"]))


def silver(
    listings: DataFrame,
    keys: Sequence[str] = ("id", "date_ref"),
    price_above: float = PRICE_ABOVE,
    ranges: Mapping[str, tuple[int, int]] = RANGES,
) -> DataFrame:
    """Typed, deduplicated, plausible listings per month.

    The filter comes after the choice of one row per identity: an implausible winner
    does not make room for the next row.
    """
    chosen = dedup_month(typed(listings), keys)
    return plausible(chosen, price_above, ranges).select(*SILVER.fieldNames())


def obt(
    listings: DataFrame, dim: DataFrame | None = None, bands: Sequence[Band] = BANDS
) -> DataFrame:
    """One enriched table over all months.

    Enrichment comes after the dedup, so that it runs once per listing that stays.
    """
    return enriched(dedup_all(listings.select(*SILVER.fieldNames())), dim, bands)


def enriched(listings: DataFrame, dim: DataFrame | None = None, bands: Sequence[Band] = BANDS) -> DataFrame:
    """Silver rows with the columns of the enriched table."""
    featured = enrich_location(listings, dim).withColumn(
        "faixa_preco", price_band(F.col("preco"), bands)
    )
    return featured.select(*OBT.fieldNames())


def mart(
    listings: DataFrame,
    by: Sequence[str],
    lag_by: Sequence[str] | None = None,
    min_listings: int = MIN_LISTINGS,
    bands: Sequence[Band] = MART_BANDS,
) -> DataFrame:
    """Statistics per group and month, with the change of the median price per m²."""
    return with_change(mart_stats(listings, by, min_listings, bands), lag_by or by)


def mart_stats(
    listings: DataFrame,
    by: Sequence[str],
    min_listings: int = MIN_LISTINGS,
    bands: Sequence[Band] = MART_BANDS,
) -> DataFrame:
    """Statistics per group and month, each from that month's listings alone.

    Medians are single precision, as the prices are; means are double.
    """
    keys = ["date_ref", *by]
    counts = value_counts(
        listings,
        keys,
        {"preco": F.col("preco"), "m2": price_per_m2(F.col("preco"), F.col("area"))},
    )
    stats = counts.groupBy(*keys).agg(
        F.sum("n").alias("qtd_imoveis"),
        *band_counts(F.col("preco"), bands, weight=F.col("n")),
        round_half_away(mean("preco")).alias("preco_medio"),
        round_half_away(mean("m2")).alias("preco_m2_medio"),
    )
    middle = quantiles(
        counts, keys, {"preco_mediano": ("preco", 0.5), "preco_m2_mediano": ("m2", 0.5)}
    )
    kept = merge_groups(keys, stats, middle).where(F.col("qtd_imoveis") > min_listings)
    for name in ("preco_mediano", "preco_m2_mediano"):
        kept = kept.withColumn(name, round_half_away(F.col(name).cast("float")).cast("float"))
    return kept.select(
        *keys,
        "qtd_imoveis",
        *[f"faixa_{band.label}" for band in bands],
        "preco_medio", "preco_m2_medio", "preco_mediano", "preco_m2_mediano",
    )


def with_change(stats: DataFrame, lag_by: Sequence[str]) -> DataFrame:
    """The change of the median price per m² since the month before, which is the last one in which
    the group had enough listings."""
    return stats.withColumn("variacao_m2_pct", change_or_zero("preco_m2_mediano", lag_by))


#: Group keys of the two marts, and the keys within which they compare months.
BY_TIPO = (["tipo"], ["tipo"])
BY_LOCALIZACAO = (["localizacao", "secretaria_regional"], ["localizacao"])


def mart_tipo(listings: DataFrame, **options) -> DataFrame:
    return mart(listings, *BY_TIPO, **options)


def mart_localizacao(listings: DataFrame, **options) -> DataFrame:
    return mart(listings, *BY_LOCALIZACAO, **options)
