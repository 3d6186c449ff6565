"""Report queries over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casario.functions import (
    MART_BANDS,
    format_currency,
    format_integer,
    format_percent,
    month_label,
    price_per_m2,
    round_half_away,
)
from casario.operators import (
    histogram,
    mean,
    medians,
    merge_groups,
    quantiles,
    series_change,
    value_counts,
)

# Report settings.
TOP = 5
MOVERS_ABOVE = 58
HISTOGRAM_UPTO = 1_000_000

# Measure labels of the descriptive table, in its order.
MEASURES = (
    "Média", "Desvio Padrão", "Quartil 1", "Quartil 2 (Mediana)", "Quartil 3",
    "Mínimo", "Máximo",
)


def with_price_m2(df: DataFrame) -> DataFrame:
    return df.withColumn("preco_m2", price_per_m2(F.col("preco"), F.col("area")))


def kpis(df: DataFrame) -> DataFrame:
    """Number of listings, mean and median price, as numbers and as text."""
    counts = value_counts(df, [], {"preco": F.col("preco")})
    basic = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), mean("preco").alias("preco_medio")
    )
    middle = quantiles(counts, [], {"preco_mediano": ("preco", 0.5)})
    row = merge_groups([], basic, middle).withColumn(
        "preco_mediano", F.col("preco_mediano").cast("float")
    )
    return row.select(
        "total",
        round_half_away(F.col("preco_medio")).alias("preco_medio"),
        round_half_away(F.col("preco_mediano")).alias("preco_mediano"),
        format_integer(F.col("total")).alias("total_texto"),
        format_currency(round_half_away(F.col("preco_medio"))).alias("preco_medio_texto"),
        format_currency(round_half_away(F.col("preco_mediano"))).alias("preco_mediano_texto"),
    )


def price_trend(df: DataFrame) -> DataFrame:
    """Median price per month and its change against the month before."""
    known = df.where(F.col("date_ref").isNotNull())
    series = medians(known, ["date_ref"], {"preco_mediano": F.col("preco")})
    return series_change(series, "preco_mediano").select(
        "date_ref",
        month_label(F.col("date_ref")).alias("mes"),
        "preco_mediano",
        "variacao_pct",
    )


def latest_change(df: DataFrame) -> DataFrame:
    """The last month's row of the trend; its change is NULL if there is only one month."""
    last = price_trend(df).orderBy(F.col("date_ref").desc()).limit(1)
    return last.withColumn("variacao_texto", format_percent(F.col("variacao_pct"), brazilian=True))


def top_m2(df: DataFrame, k: int = TOP) -> DataFrame:
    """Locations with the highest median price per m²."""
    known = df.where(F.col("localizacao").isNotNull())
    ratio = price_per_m2(F.col("preco"), F.col("area"))
    ranked = medians(known, ["localizacao"], {"preco_m2": ratio})
    return ranked.orderBy(F.col("preco_m2").desc(), F.col("localizacao")).limit(k)


def location_rank(df: DataFrame, k: int | None = TOP) -> DataFrame:
    """Mean price and median price per m² by location, dearest per m² first.

    k=None returns every location, unsorted.
    """
    known = df.where(F.col("localizacao").isNotNull())
    keys = ["localizacao"]
    counts = value_counts(
        known,
        keys,
        {"preco": F.col("preco"), "m2": price_per_m2(F.col("preco"), F.col("area"))},
    )
    ranked = merge_groups(
        keys,
        counts.groupBy(*keys).agg(round_half_away(mean("preco")).alias("preco_medio")),
        quantiles(counts, keys, {"m2_mediano": ("m2", 0.5)}),
    )
    if k is None:
        return ranked
    return ranked.orderBy(F.col("m2_mediano").desc(), F.col("localizacao")).limit(k)


def type_change_table(mart: DataFrame, month: str, types: Sequence[str] | None = None) -> DataFrame:
    """Median prices and change of one month by type, as text."""
    rows = mart.where(F.col("date_ref") == month)
    if types is not None:
        rows = rows.where(F.col("tipo").isin(list(types)))
    return rows.select(
        "tipo",
        format_currency(F.col("preco_mediano")).alias("preco_mediano"),
        format_currency(F.col("preco_m2_mediano")).alias("preco_m2_mediano"),
        format_percent(F.col("variacao_m2_pct")).alias("variacao"),
    )


def movers(
    mart: DataFrame,
    month: str,
    min_count: int = MOVERS_ABOVE,
    k: int = TOP,
    rising: bool = True,
) -> DataFrame:
    """Locations with the strongest rise or fall of one month, ties by name."""
    enough = mart.where((F.col("qtd_imoveis") > min_count) & (F.col("date_ref") == month))
    change = F.col("variacao_m2_pct")
    lead: Column = change.desc_nulls_last() if rising else change.asc_nulls_last()
    return (
        enough.orderBy(lead, F.col("localizacao").asc_nulls_last(), "secretaria_regional")
        .limit(k)
        .select(
            "localizacao",
            "secretaria_regional",
            "variacao_m2_pct",
            format_percent(change).alias("variacao_texto"),
        )
    )


def band_leaders(mart: DataFrame, bands: int = len(MART_BANDS)) -> DataFrame:
    """Per price band the location and month with the most listings, ties as rows.

    The rank filter keeps only local leaders before the shuffle.
    """
    cells = [cell for i in range(1, bands + 1) for cell in (F.lit(i), F.col(f"faixa_{i}"))]
    long = mart.select(
        "date_ref", "localizacao", "preco_mediano",
        F.stack(F.lit(bands), *cells).alias("faixa", "total"),
    )
    place = F.rank().over(Window.partitionBy("faixa").orderBy(F.col("total").desc()))
    leaders = long.withColumn("place", place).where(F.col("place") == 1)
    return leaders.select(
        "faixa",
        "date_ref",
        "localizacao",
        "total",
        format_currency(F.col("preco_mediano")).alias("preco_mediano"),
    )


def describe_price(df: DataFrame, column: str = "preco") -> DataFrame:
    """Seven labelled measures of a column, one row each."""
    counts = value_counts(df, [], {column: F.col(column)})
    value = F.col(column).cast("double")
    known = F.sum(F.when(value.isNotNull(), F.col("n")))
    centre = counts.agg(mean(column)).scalar()
    spread = F.sum(F.col("n") * (value - centre) * (value - centre))
    basic = counts.agg(
        mean(column).alias("m0"),
        F.sqrt(F.try_divide(spread, known - 1)).alias("m1"),
        F.min(value).alias("m5"),
        F.max(value).alias("m6"),
    )
    quarters = quantiles(
        counts, [], {"m2": (column, 0.25), "m3": (column, 0.5), "m4": (column, 0.75)}
    )
    row = merge_groups([], basic, quarters).withColumn("m3", F.col("m3").cast("float"))
    cells = [
        cell
        for i, label in enumerate(MEASURES)
        for cell in (F.lit(i + 1), F.lit(label), F.col(f"m{i}").cast("double"))
    ]
    long = row.select(F.stack(F.lit(len(MEASURES)), *cells).alias("ordem", "medida", "valor"))
    rounded = round_half_away(F.col("valor"))
    return long.select(
        "ordem", "medida", rounded.alias("resultado"), format_currency(rounded).alias("texto")
    )


def band_by_type(df: DataFrame) -> DataFrame:
    """Listings per type and price band."""
    known = df.where(F.col("tipo").isNotNull() & F.col("faixa_preco").isNotNull())
    return known.groupBy("tipo", "faixa_preco").agg(F.count("preco").alias("total"))


def price_histogram(
    df: DataFrame, width: float = 50_000, upto: float = HISTOGRAM_UPTO
) -> DataFrame:
    """Price distribution per type up to a price, in percent of the type."""
    return histogram(df.where(F.col("preco") <= upto), "preco", width, "tipo")


def price_bounds(df: DataFrame) -> DataFrame:
    """Whole-number bounds for a price slider."""
    return df.agg(
        F.min("preco").cast("bigint").alias("preco_min"),
        F.max("preco").cast("bigint").alias("preco_max"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The choices for a filter, as sorted text."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())
