"""Listing records out of stored portal pages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casario.functions import clean_location, clean_price, first_token, strip_query
from casario.operators.pages import (
    Element,
    at,
    base_of,
    card_list,
    element,
    link_to_next,
    on_hosts,
    resolve,
    shown_texts,
)
from casario.schema import FEED

FIELDS = FEED.fieldNames()


# The last result page that is asked for, by numbered address and by link.
LAST_NUMBERED, LAST_LINKED = 50, 99


@dataclass(frozen=True)
class Texts:
    """A list of text nodes on a card: under `pattern`, inside `within` if given."""

    pattern: Element
    within: Element | None = None

    def read(self, card: Column) -> Column:
        return shown_texts(card, self.pattern, self.within)


@dataclass(frozen=True)
class Pick:
    """A field: one entry of a text list, counted from either end, and its cleaning."""

    source: str
    index: int
    clean: Callable[[Column], Column] = lambda text: text

    def read(self) -> Column:
        return self.clean(at(F.col(self.source), self.index))


@dataclass(frozen=True)
class PortalSpec:
    """What differs between portals: addresses, card tag, text lists, field positions."""

    name: str
    hosts: tuple[str, ...]
    template: str
    categories: Mapping[str, str]
    card: Element
    lists: Mapping[str, Texts]
    picks: Mapping[str, Pick]


_TRIMMED: Callable[[Column], Column] = lambda text: clean_location(text, trim=True)

# Class names, attributes and positions of the portals' page layouts.
_A_LISTS = {
    "rooms": Texts(element("p"), element("span", ["style-module__PkTDxW__list"])),
    "place": Texts(element("p"), element("address", ["style-module__PkTDxW__address"])),
    "price": Texts(element("b"), element("p")),
    "fee": Texts(element("small"), element("p", ["column", "style-module__PkTDxW__price"])),
}
_A_PICKS = {
    "preco": Pick("price", 0, clean_price),
    "localizacao": Pick("place", 1, clean_location),
    "area": Pick("rooms", 1),
    "quartos": Pick("rooms", 3),
    "vagas": Pick("rooms", 5),
    "banheiros": Pick("rooms", 7),
    "condo": Pick("fee", 1, clean_price),
}
_B_LISTS = {
    "rooms": Texts(
        element("h3"),
        element(
            "ul", ["flex", "flex-row", "text-1-75", "text-neutral-110", "text-nowrap", "gap-3"]
        ),
    ),
    "place": Texts(element("h2", attrs={"data-cy": "rp-cardProperty-location-txt"})),
    "price": Texts(element("p"), element("div", ["shrink", "grow", "text-nowrap", "min-w-0"])),
}
_B_PICKS = {
    "preco": Pick("price", 0, clean_price),
    "localizacao": Pick("place", -1, _TRIMMED),
    "area": Pick("rooms", 0, first_token),
    "quartos": Pick("rooms", 1),
    "banheiros": Pick("rooms", 2),
    "vagas": Pick("rooms", 3),
    "condo": Pick("price", 1),
}

PORTALS = (
    PortalSpec(
        name="chaves",
        hosts=("www.chavesnamao.com.br",),
        template="https://www.chavesnamao.com.br/{tipo}/ce-fortaleza/",
        categories={
            "Casa": "casas-a-venda",
            "Apartamento": "apartamentos-a-venda",
            "Condomínio": "casas-em-condominio-a-venda",
        },
        card=element("span", ["card-module__1awNxG__cardContent"]),
        lists=_A_LISTS,
        picks=_A_PICKS,
    ),
    PortalSpec(
        name="vivareal",
        hosts=("www.vivareal.com.br",),
        template="https://www.vivareal.com.br/venda/ceara/fortaleza/{tipo}",
        categories={
            "Apartamento": "apartamento_residencial",
            "Casa": "casa_residencial",
            "Condomínio": "condominio_residencial",
        },
        card=element("li", attrs={"data-cy": "rp-property-cd"}),
        lists=_B_LISTS,
        picks=_B_PICKS,
    ),
    PortalSpec(
        name="zap",
        hosts=("www.zapimoveis.com.br",),
        template="https://www.zapimoveis.com.br/venda/{tipo}/ce+fortaleza/",
        categories={
            "Casa": "casas",
            "Apartamento": "apartamentos",
            "Condomínio": "casas-de-condominio",
        },
        card=element("div", ["flex", "flex-col", "content-stretch"]),
        lists=_B_LISTS,
        picks=_B_PICKS,
    ),
)


def portal_table(spark: SparkSession, portals: Sequence[PortalSpec] = PORTALS) -> DataFrame:
    """Portal name, address template and categories, one row per portal."""
    categories = [
        [{"tipo": tipo, "slug": slug} for tipo, slug in spec.categories.items()]
        for spec in portals
    ]
    return spark.createDataFrame(
        pa.table(
            {
                "portal": [spec.name for spec in portals],
                "template": [spec.template for spec in portals],
                "categories": categories,
            }
        )
    )


def seed_urls(portals: DataFrame) -> DataFrame:
    """First page address per portal and category."""
    one_each = portals.select("portal", "template", F.explode("categories").alias("c"))
    url = F.replace(F.col("template"), F.lit("{tipo}"), F.col("c.slug"))
    return one_each.select(
        "portal", F.col("c.tipo").alias("tipo"), url.alias("url"), F.lit(1).alias("page")
    )


def page_urls(seeds: DataFrame, max_page: int = LAST_NUMBERED) -> DataFrame:
    """Addresses of all result pages: the seed, then ?pagina=2 and so on."""
    others = [name for name in seeds.columns if name not in ("url", "page")]
    numbered = seeds.select(
        *others, "url", F.explode(F.sequence(F.lit(1), F.lit(max_page))).alias("page")
    )
    later = F.concat(strip_query(F.col("url")), F.lit("?pagina="), F.col("page").cast("string"))
    url = F.when(F.col("page") == 1, F.col("url")).otherwise(later)
    return numbered.withColumn("url", url)


def follow_links(pages: DataFrame, last_page: int = LAST_LINKED) -> DataFrame:
    """The next page that each stored page links to, for portals without page numbers."""
    others = [name for name in pages.columns if name not in ("url", "page", "html")]
    linked = pages.where(F.col("page") < last_page).select(
        *others, "url", "page", link_to_next(F.col("html")).alias("_link"), base_of(F.col("html")).alias("_base")
    ).where(F.col("_link") != "")
    based = F.when(F.coalesce(F.col("_base"), F.lit("")) != "", resolve(F.col("url"), F.col("_base")))
    found = linked.withColumn("url", F.coalesce(based, "url")).withColumn("url", resolve(F.col("url"), F.col("_link")))
    return found.select(*others, "url", (F.col("page") + 1).alias("page"))


def allowed(pages: DataFrame, portals: Sequence[PortalSpec] = PORTALS) -> DataFrame:
    """Pages on the portals' own hosts."""
    return pages.where(on_hosts(F.col("url"), [host for spec in portals for host in spec.hosts]))


def unknown_portals(pages: DataFrame, portals: Sequence[PortalSpec] = PORTALS) -> DataFrame:
    """Pages whose portal has no layout, counted by portal."""
    known = F.coalesce(F.lower("portal").isin([spec.name for spec in portals]), F.lit(False))
    return pages.where(~known).groupBy("portal").agg(F.count(F.lit(1)).alias("n"))


def extract_listings(
    pages: DataFrame, portals: Sequence[PortalSpec] = PORTALS, keep: Sequence[str] = ()
) -> DataFrame:
    """Feed records of all cards on the pages, plus the page columns named in `keep`.

    `pages` has url, html, portal, tipo and page.  One pass serves all portals: the
    portal column chooses the layout row by row, in either case.  Each text list of a card is
    read once and its entries are picked afterwards.  A page of an unknown portal fails the
    job; see `unknown_portals`.
    """

    def by_portal(choose: Callable[[PortalSpec], object], build: Callable[..., Column]) -> Column:
        """Value by portal; portals with the same layout share a branch."""
        layouts: dict[object, list[str]] = {}
        for spec in portals:
            layouts.setdefault(choose(spec), []).append(spec.name)
        result = F.lit(None)
        for layout, names in layouts.items():
            if layout is not None:
                result = F.when(F.lower("portal").isin(names), build(layout)).otherwise(result)
        return result

    carried = list(dict.fromkeys(["portal", "tipo", *keep]))
    found = by_portal(lambda spec: spec.card, lambda card: card_list(F.col("html"), card))
    unknown = F.raise_error(F.concat(F.lit("no layout for portal "), F.coalesce("portal", F.lit("NULL"))))
    known = F.lower("portal").isin([spec.name for spec in portals])
    found = F.when(F.coalesce(known, F.lit(False)), found).otherwise(unknown)
    each = pages.select(*carried, F.explode(found).alias("card"))
    sources = list(dict.fromkeys(name for spec in portals for name in spec.lists))
    lists = each.select(
        *carried,
        *[
            by_portal(lambda spec, name=name: spec.lists.get(name),
                      lambda source: source.read(F.col("card"))).alias(name)
            for name in sources
        ],
    )
    fields = [
        F.col(name)
        if name == "tipo"
        else by_portal(lambda spec, name=name: spec.picks[name], lambda pick: pick.read()).alias(name)
        for name in FIELDS
    ]
    return lists.select(*fields, *[name for name in keep if name not in FIELDS])
