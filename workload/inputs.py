"""Listing inputs derived from the order tables: one listing per order line.

The same rules are written once for Spark here and once as SQL in `oracle.py`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casario.plans.layers import mart_localizacao, mart_tipo, obt, silver

# One neighbourhood per nation: all regions, spelling variants, and names that match none.
PLACES = [
    "Vila Velha", "BARRA DO CEARÁ", "Meireles", "ALDEOTA", "Joaquim Távora",
    "Joaquim Tavora", "Quintino Cunha", "Farias Brito", "Benfica", "Montese",
    "Bom Jardim", "Messejana", "Cambeba", "Praia do Futuro", "COCÓ",
    "Passaré", "Serrinha", "Jangurussu", "Pedras", "Mondubim",
    "Maraponga", "Pici", "Centro", " Centro", "Areia & Mar",
]

MONTH = "1997-05"

#: Movers have more listings than this; the mart has groups below and above.
MANY = 25


# Declared, so that opening a table costs no job to infer its columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_extendedprice double"
    ),
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def place(nation: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in PLACES]), nation + 1)


def every(n: int) -> Column:
    return F.col("l_orderkey") % n == 0


def listings_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw listings, all text, with the mess that silver has to clean.

    Lines of every 13th order are listed again in the following month.
    """
    # Orders meet customers before the many lines do, which are shuffled once less.
    placed = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = (
        table(spark, sf, "lineitem")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    month = lambda day: F.substring(day.cast("date").cast("string"), 1, 7)
    listed = month(F.col("o_orderdate"))
    again = month(F.add_months(F.col("o_orderdate"), 1))
    size = (F.col("p_size") * 10).cast("string")
    amount = F.concat(
        F.lit("R$ "),
        F.replace(
            F.format_number(F.floor(F.col("l_extendedprice") * 60), 0), F.lit(","), F.lit(".")
        ),
    )
    return lines.select(
        F.concat(F.lit("portal_"), (F.col("l_suppkey") % 3).cast("string")).alias("origem"),
        F.explode(
            F.when(every(13), F.array(listed, again)).otherwise(F.array(listed))
        ).alias("date_ref"),
        F.col("p_type").alias("tipo"),
        F.when(~every(101), F.concat(place(F.col("n_nationkey")), F.lit(", "), F.col("r_name")))
        .alias("localizacao"),
        F.when(every(17), F.lit("60-80"))
        .when(every(19), F.lit("75.5"))
        .when(every(23), F.concat(F.lit("  "), size, F.lit(" ")))
        .otherwise(size)
        .alias("area"),
        F.col("l_linenumber").cast("string").alias("quartos"),
        (F.col("l_linenumber") % 4).cast("string").alias("banheiros"),
        (F.col("l_partkey") % 12).cast("string").alias("vagas"),
        F.when(every(29), F.lit(None))
        .when(every(31), F.lit("Sob consulta"))
        .otherwise(F.concat(amount, F.when(every(37), F.lit(",50")).otherwise(F.lit(""))))
        .alias("preco"),
        F.when(~every(3), F.concat(F.lit("R$ "), (F.col("l_partkey") % 900).cast("string")))
        .alias("condo"),
    )


def silver_listings(spark: SparkSession, sf: str) -> DataFrame:
    return silver(listings_raw(spark, sf))


def gold_listings(spark: SparkSession, sf: str) -> DataFrame:
    return obt(silver_listings(spark, sf))


def type_mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_tipo(gold_listings(spark, sf))


def location_mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_localizacao(gold_listings(spark, sf))


def nation_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """A location dimension of the user's own: neighbourhoods by world region.

    Every fourth neighbourhood is unknown to it, and every third is listed twice."""
    nations = table(spark, sf, "nation").where("n_nationkey % 4 <> 3")
    nations = nations.unionByName(nations.where("n_nationkey % 3 = 0")).join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        F.lower(place(F.col("n_nationkey"))).alias("name"),
        F.col("r_name").alias("region"),
        (F.col("n_nationkey") % 2 == 0).alias("shore"),
        (F.col("n_nationkey") % 5 == 0).alias("centre"),
    )


# --- portal pages -----------------------------------------------------------------

# Two cards per page: a full one, and one that carries nothing but a location.
_PAGE_A = """<html><body><p>menu</p><div>
<span class="x card-module__1awNxG__cardContent"><p>Oferta<b>{preco}</b></p>
<address class="style-module__PkTDxW__address"><p>Rua <i>A</i></p><p>{localizacao}</p></address>
<span class="style-module__PkTDxW__list"><span title="i"></span><p>Área</p><p>{area}</p>
<p>Quartos</p><p>{quartos}</p><p>Vagas</p><p>{vagas}</p><p>Banheiros</p><p>{banheiros}</p></span>
<p class="column style-module__PkTDxW__price"><small>Condomínio</small><small>{condo}</small></p>
</span></div><div><span class="card-module__1awNxG__cardContent">
<address class="style-module__PkTDxW__address"><p>Rua</p><p>{localizacao}</p></address>
</span></div></body></html>"""

_CARDS_B = """
<h2 data-cy="rp-cardProperty-location-txt"><b>Venda</b>em<br> {localizacao}</h2>
<ul class="flex flex-row text-1-75 text-neutral-110 text-nowrap gap-3"><li><h3>{area} m²</h3></li>
<li><h3>{quartos}</h3></li><li><h3>{banheiros}</h3></li><li><h3>{vagas}</h3></li></ul>
<div class="shrink grow text-nowrap min-w-0"><div><p>{preco}</p></div><p>{condo}</p></div>"""

_BARE_B = """<h2 data-cy="rp-cardProperty-location-txt">{localizacao}<i>!</i> </h2>"""


def _page_b(opening: str, closing: str) -> str:
    cards = "\n".join(f"{opening}{body}{closing}" for body in (_CARDS_B, _BARE_B))
    return f"<html><body><h3>menu</h3>{cards}</body></html>"


# Portal and page layout by origin.
_LAYOUTS = {
    "portal_0": ("chaves", _PAGE_A),
    "portal_1": ("vivareal", _page_b('<li class="c" data-cy="rp-property-cd">', "</li>")),
    "portal_2": ("zap", _page_b('<div class="flex flex-col content-stretch">', "</div>")),
}


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A stored result page per raw listing, in the layout of its portal."""

    def filled(layout: str) -> Column:
        # Pieces of the layout by turns with names of columns.
        pieces = re.split(r"\{(\w+)\}", layout)
        value = lambda name: F.replace(F.coalesce(name, F.lit("")), F.lit("&"), F.lit("&amp;"))
        return F.concat(*[value(piece) if i % 2 else F.lit(piece) for i, piece in enumerate(pieces)])

    portal, html = F.lit(None), F.lit(None)
    for origem, (name, layout) in _LAYOUTS.items():
        here = F.col("origem") == origem
        portal = F.when(here, F.lit(name)).otherwise(portal)
        html = F.when(here, filled(layout)).otherwise(html)
    return listings_raw(spark, sf).select(
        "origem",
        "date_ref",
        "tipo",
        portal.alias("portal"),
        F.lit(1).alias("page"),
        html.alias("html"),
    )


def linked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The stored pages with a next-page link of varying form added at the end."""
    kind = F.col("page_id") % 6
    number = (F.col("page_id") + 1).cast("string")
    href = (
        F.when(kind == 0, F.concat(F.lit("/lista?pg="), number, F.lit("&amp;o=1")))
        .when(kind == 1, F.concat(F.lit("https://www.example.org/p/"), number))
        .when(kind == 2, F.concat(F.lit("//cdn.example.org/p/"), number))
        .when(kind == 3, F.concat(F.lit("?pg="), number))
        .when(kind == 4, F.concat(F.lit("../"), number, F.lit("/x.html")))
    )
    link = F.concat(F.lit('<a class="n" href="'), href, F.lit('" rel="next">&gt;</a>'))
    return table(spark, sf, "pages").select(
        "page_id",
        "url",
        F.concat("html", F.coalesce(link, F.lit(""))).alias("html"),
        (F.col("page_id") % 100).cast("int").alias("page"),
    )


def page_kind(pages: DataFrame) -> DataFrame:
    """Request metadata read off the address: language as kind, page number."""
    number = F.regexp_extract("url", r"[?&]page=([0-9]+)", 1)
    return pages.select(
        "page_id",
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1).alias("tipo"),
        F.coalesce(F.nullif(number, F.lit("")).cast("int"), F.lit(1)).alias("page"),
        "html",
    )

