"""One Spark query per operator of the survey, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casario.functions import (
    band_counts,
    before_comma,
    clean_location,
    clean_price,
    first_token,
    format_currency,
    format_integer,
    format_percent,
    listing_id,
    month_label,
    or_zero,
    origin_of,
    price_band,
    price_digits,
    round_half_away,
    try_int,
    try_real,
)
from casario.functions.features import ID_FIELDS
from casario.operators import (
    enrich_location,
    filter_listings,
    not_null,
    plausible,
    region_case,
    shares,
    sum_by,
    union_by_name,
    unique,
)
from casario.operators.change import change_or_zero, previous
from casario.operators.pages import at, attributes, cards, element, on_hosts, texts
from casario.plans import extraction, layers, report
from casario.schema import FEED
from casario.sources import folder_table_of, parse_lines, query_data
from workload import inputs
from workload.inputs import MANY, MONTH, table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; a final underscore only avoids a clash."""
    _REGISTRY[build.__name__.rstrip("_")] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def doubles(df: DataFrame) -> DataFrame:
    """Single precision columns as double, for comparison."""
    return df.select(
        *[F.col(n).cast("double").alias(n) if t == "float" else F.col(n) for n, t in df.dtypes]
    )


def counted(df: DataFrame, *keys: str, **extra: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[column.alias(name) for name, column in extra.items()]
    )


# --- sources -----------------------------------------------------------------------


@query
def origin_tag(spark, sf):
    key = F.col("s_suppkey")
    file_name = (
        F.when(key % 4 == 0, F.concat(F.lit("a_CHAVES_"), "s_name", F.lit(".json")))
        .when(key % 4 == 1, F.concat("s_name", F.lit("_VivaReal.json")))
        .when(key % 4 == 2, F.concat(F.lit("zap-"), "s_name", F.lit("-chaves.json")))
        .otherwise(F.concat("s_name", F.lit(".json")))
    )
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        file_name.alias("file_name"),
        origin_of(file_name).alias("origem"),
        F.lit(MONTH).alias("date_ref"),
    )


@query
def union_sources(spark, sf):
    raw = inputs.listings_raw(spark, sf)
    without_fee = raw.where(F.col("origem") == "portal_0").drop("condo")
    others = raw.where(F.col("origem") != "portal_0").select(*reversed(raw.columns))
    return counted(
        union_by_name([without_fee, others]),
        "origem", "tipo", "quartos",
        with_fee=F.count("condo"), with_price=F.count("preco"),
    )


@query
def bronze(spark, sf):
    layers.stamped(layers.bronze(inputs.listings_raw(spark, sf))).createOrReplaceTempView("bronze")
    return spark.table("bronze").drop("ingestion_timestamp")


@query
def adhoc_obt_m2(spark, sf):
    gold = inputs.gold_listings(spark, sf)
    result = query_data(
        spark,
        "SELECT id, date_ref, preco, area, CAST(preco / area AS FLOAT) AS preco_m2 FROM {obt}",
        obt=gold,
    )
    return doubles(result)


@query
def feed_lines(spark, sf):
    """Listings written as the lines of a JSON array and read again.

    Where the price is 'Sob consulta' it is written as a JSON number with a fraction."""
    raw = inputs.listings_raw(spark, sf)
    record = F.to_json(F.struct(*FEED.fieldNames()), {"ignoreNullFields": "false"})
    number = F.concat(F.lit('"preco":'), (F.col("area").try_cast("int") * 1000).cast("string"), F.lit(".50"))
    asked = F.when(F.col("area").try_cast("int").isNotNull(), F.replace(record, F.lit('"preco":"Sob consulta"'), number)).otherwise(record)
    line = F.concat(F.when(F.col("quartos") == "1", "[").otherwise(" "), asked, F.when(F.col("quartos") == "2", "]").otherwise(","))
    return parse_lines(raw.select(line.alias("value"), "origem", "date_ref"))


@query
def audit(spark, sf):
    rows = layers.stamped(layers.bronze(inputs.listings_raw(spark, sf)))
    stamp = F.col(layers.AUDIT)
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(stamp.isNull(), 1)).alias("sem_data"),
        F.count_distinct(stamp).alias("datas"),
        (F.max(stamp) <= F.current_timestamp()).alias("passado"),
    )


@query
def folder_tables(spark, sf):
    return table(spark, sf, "pages").select("page_id", folder_table_of(F.col("url")).alias("tabela"))


# --- pages -------------------------------------------------------------------------


@query
def seed_urls(spark, sf):
    portals = table(spark, sf, "supplier").select(
        F.col("s_name").alias("portal"),
        F.concat(F.lit("https://www."), F.lower("s_name"), F.lit(".example/{tipo}/venda/")).alias(
            "template"
        ),
        F.array(
            F.struct(F.lit("Casa").alias("tipo"), F.lit("casas").alias("slug")),
            F.struct(F.lit("Apartamento").alias("tipo"), F.lit("apartamentos").alias("slug")),
        ).alias("categories"),
    )
    return extraction.seed_urls(portals)


@query
def page_urls(spark, sf):
    seeds = table(spark, sf, "pages").select("page_id", "url", F.lit(1).alias("page"))
    return extraction.page_urls(seeds, 50)


@query
def next_link(spark, sf):
    return extraction.follow_links(inputs.linked_pages(spark, sf), 99)


@query
def page_links(spark, sf):
    links = attributes(F.col("html"), "a", "href")
    return table(spark, sf, "pages").select(
        "page_id",
        F.size(links).cast("bigint").alias("n_links"),
        at(links, 0).alias("first_link"),
        F.array_join(links, " ").alias("links"),
    )


@query
def host_filter(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.where(on_hosts(F.col("url"), ["example.com", "spam-farm.example.org"])).select(
        "page_id", "url"
    )


@query
def page_cards(spark, sf):
    return cards(inputs.page_kind(table(spark, sf, "pages")), element("p"))


@query
def page_texts(spark, sf):
    names = texts(F.col("html"), element("a"), within=element("nav"))
    return table(spark, sf, "pages").select(
        "page_id",
        F.size(names).cast("bigint").alias("n_texts"),
        at(names, 1).alias("second"),
        at(names, 40).alias("out_of_range"),
        at(names, -1).alias("last"),
        F.array_join(names, "|").alias("texts"),
    )


@query
def page_title(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        at(texts(F.col("html"), element("title")), 0).alias("title"),
        at(texts(F.col("html"), element("div", ["ad"])), 0).alias("ad"),
    )


@query
def extract_listings(spark, sf):
    pages = inputs.listing_pages(spark, sf)
    return extraction.extract_listings(pages, keep=["origem", "date_ref", "page"])


# --- scalar functions --------------------------------------------------------------


@query
def first_token_(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", "p_name")
    return named.withColumn("token", first_token(F.col("p_name")))


def _raw_values(spark, sf, column: str) -> DataFrame:
    return counted(inputs.listings_raw(spark, sf), column)


@query
def clean_price_(spark, sf):
    amounts = _raw_values(spark, sf, "preco")
    return amounts.select(
        "preco",
        "n",
        clean_price(F.col("preco")).alias("cleaned"),
        price_digits(F.col("preco")).alias("digits"),
    )


@query
def clean_location_(spark, sf):
    return _raw_values(spark, sf, "localizacao").select(
        "localizacao",
        "n",
        clean_location(F.col("localizacao")).alias("bairro"),
        clean_location(F.col("localizacao"), trim=True).alias("bairro_sem_espaco"),
        before_comma(F.concat("localizacao", F.lit(",x"))).alias("antes"),
    )


@query
def cast_int(spark, sf):
    return _raw_values(spark, sf, "area").select(
        "area",
        "n",
        try_int(F.col("area")).cast("bigint").alias("inteiro"),
        or_zero(try_int(F.col("area"))).cast("bigint").alias("ou_zero"),
    )


@query
def cast_real(spark, sf):
    number = try_real(price_digits(F.col("preco"))).cast("double")
    return _raw_values(spark, sf, "preco").select(
        "preco", "n", number.alias("numero"), or_zero(number).alias("ou_zero")
    )


@query
def listing_id_(spark, sf):
    fields = [F.col(name) for name in ID_FIELDS]
    raw = inputs.listings_raw(spark, sf)
    return counted(raw.select(listing_id(*fields).alias("id")), "id")


def _balances(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal")


@query
def format_currency_(spark, sf):
    return _balances(spark, sf).withColumn("texto", format_currency(F.col("c_acctbal")))


@query
def format_number(spark, sf):
    return _balances(spark, sf).withColumn("texto", format_integer(F.col("c_acctbal")))


@query
def format_percent_(spark, sf):
    return (
        _balances(spark, sf)
        .withColumn("texto", format_percent(F.col("c_acctbal")))
        .withColumn("texto_br", format_percent(F.col("c_acctbal"), brazilian=True))
    )


@query
def month_label_(spark, sf):
    raw = counted(inputs.listings_raw(spark, sf), "date_ref")
    return raw.withColumn("mes", month_label(F.col("date_ref")))


# --- warehouse layers --------------------------------------------------------------


@query
def dedup_month(spark, sf):
    return doubles(layers.dedup_month(layers.typed(inputs.listings_raw(spark, sf))))


@query
def plausible_(spark, sf):
    return counted(
        plausible(layers.typed(inputs.listings_raw(spark, sf))), "date_ref", "tipo", "localizacao"
    )


@query
def silver(spark, sf):
    return doubles(inputs.silver_listings(spark, sf))


@query
def union_months(spark, sf):
    """Snapshots of single months, stacked, against which the one-pass silver is checked."""
    raw = inputs.listings_raw(spark, sf)
    halves = [
        layers.silver(raw.where(F.col("date_ref") < MONTH)),
        layers.silver(raw.where(F.col("date_ref") >= MONTH)),
    ]
    return counted(union_by_name(halves), "date_ref", "origem")


@query
def dedup_all(spark, sf):
    return doubles(layers.dedup_all(inputs.silver_listings(spark, sf)))


@query
def obt(spark, sf):
    return doubles(inputs.gold_listings(spark, sf))


@query
def region_case_(spark, sf):
    region = region_case(F.col("localizacao")).alias("regiao")
    return counted(inputs.silver_listings(spark, sf).select("localizacao", region), "localizacao", "regiao")


@query
def region_join(spark, sf):
    dim = inputs.nation_dimension(spark, sf)
    joined = enrich_location(inputs.silver_listings(spark, sf), dim)
    return counted(joined, "localizacao", "secretaria_regional", "prox_orla", "prox_centro")


@query
def price_band_(spark, sf):
    prices = counted(inputs.silver_listings(spark, sf), "preco")
    return doubles(prices.withColumn("faixa_preco", price_band(F.col("preco"))))


@query
def band_counts_(spark, sf):
    gold = inputs.gold_listings(spark, sf)
    return gold.groupBy("date_ref").agg(*band_counts(F.col("preco")))


@query
def mart_type(spark, sf):
    return doubles(inputs.type_mart(spark, sf))


@query
def mart_location(spark, sf):
    return doubles(inputs.location_mart(spark, sf))


@query
def mom_change(spark, sf):
    """Change of the mean price per type, single precision as in the marts."""
    gold = inputs.gold_listings(spark, sf)
    monthly = gold.groupBy("tipo", "date_ref").agg(
        round_half_away(F.avg("preco")).cast("float").alias("media")
    )
    return doubles(
        monthly.select(
            "tipo",
            "date_ref",
            "media",
            previous("media", ["tipo"]).alias("anterior"),
            change_or_zero("media", ["tipo"]).alias("variacao_pct"),
        )
    )


@query
def dq_unique(spark, sf):
    return unique(inputs.silver_listings(spark, sf), "id")


@query
def dq_not_null(spark, sf):
    return doubles(not_null(inputs.silver_listings(spark, sf), "id").drop("id"))


# --- reports -----------------------------------------------------------------------


@query
def filter_listings_(spark, sf):
    return doubles(
        filter_listings(
            inputs.gold_listings(spark, sf),
            tipo="PROMO",
            locations=["Meireles", "ALDEOTA", "COCÓ", "Centro"],
            region="2",
            price_min=400_000,
            price_max=3_000_000,
        )
    )


@query
def kpis(spark, sf):
    return doubles(report.kpis(inputs.gold_listings(spark, sf)))


@query
def price_trend(spark, sf):
    return doubles(report.price_trend(inputs.gold_listings(spark, sf)))


@query
def price_trend_type(spark, sf):
    gold = filter_listings(inputs.gold_listings(spark, sf), tipo="ECONOMY")
    return doubles(report.price_trend(gold))


@query
def latest_change(spark, sf):
    return doubles(report.latest_change(inputs.gold_listings(spark, sf)))


@query
def top_m2(spark, sf):
    return doubles(report.top_m2(inputs.gold_listings(spark, sf)))


@query
def location_rank(spark, sf):
    return doubles(report.location_rank(inputs.gold_listings(spark, sf), k=None))


@query
def top_gainers(spark, sf):
    return doubles(report.movers(inputs.location_mart(spark, sf), MONTH, min_count=MANY))


@query
def top_losers(spark, sf):
    mart = inputs.location_mart(spark, sf)
    return doubles(report.movers(mart, MONTH, min_count=MANY, rising=False))


@query
def type_change_table(spark, sf):
    return report.type_change_table(inputs.type_mart(spark, sf), MONTH)


@query
def band_leaders(spark, sf):
    return report.band_leaders(inputs.location_mart(spark, sf))


@query
def describe_price(spark, sf):
    return report.describe_price(inputs.gold_listings(spark, sf))


@query
def price_bounds(spark, sf):
    return report.price_bounds(inputs.gold_listings(spark, sf))


@query
def distinct_values(spark, sf):
    return report.distinct_values(inputs.gold_listings(spark, sf), "secretaria_regional")


@query
def band_by_type(spark, sf):
    return report.band_by_type(inputs.gold_listings(spark, sf))


@query
def share_by_type(spark, sf):
    return shares(inputs.gold_listings(spark, sf), "tipo")


@query
def share_by_band(spark, sf):
    return shares(inputs.gold_listings(spark, sf), "faixa_preco")


@query
def price_hist(spark, sf):
    return report.price_histogram(inputs.gold_listings(spark, sf))


@query
def bar_sum(spark, sf):
    total = sum_by(inputs.gold_listings(spark, sf), "localizacao", "preco")
    return total.withColumn("total", round_half_away(F.col("total")))
