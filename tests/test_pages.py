from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casario.operators import pages as P
from casario.plans import extraction
from helpers import column

PAGE_A = """<html><body><p>menu</p>
<span class="card-module__1awNxG__cardContent big"><p>Venda <b>R$ 1.200.000</b></p>
 <address class="style-module__PkTDxW__address"><p>Rua A</p><p>Meireles &amp; Cia, Fortaleza</p></address>
 <span class="style-module__PkTDxW__list"><span><p>Área</p></span><p>70</p><p>Quartos</p><p>3</p>
  <p>Vagas</p><p>2</p><p>Banheiros</p><p>4</p></span>
 <p class="column style-module__PkTDxW__price"><small>Cond.</small><small> R$&nbsp;1.050 </small></p>
</span>
<span class="card-module__1awNxG__cardContent"><p>sem valor</p>
 <address class="style-module__PkTDxW__address"><p>só rua</p></address></span>
<a class="n" rel="next" href="/lista?pg=2&amp;o=1">&gt;</a></body></html>"""

ROOMS = "flex flex-row text-1-75 text-neutral-110 text-nowrap gap-3"
CARD_B = f"""<h2 data-cy="rp-cardProperty-location-txt"><b>Casa</b>em<br> Aldeota, Fortaleza </h2>
<ul class="{ROOMS}"><li><h3>70 m²</h3></li><li><h3>2</h3></li><li><h3><i></i>1</h3></li></ul>
<div class="shrink grow text-nowrap min-w-0"><div><p>R$ 350.000</p></div><p>Cond. R$ 500</p></div>"""
PAGE_VIVA = f'<ul><li data-cy="rp-property-cd" class="x">{CARD_B}</li><li data-cy="rp-property-cd"></li></ul>'
PAGE_ZAP = f'<div class="flex x flex-col content-stretch">{CARD_B}</div><div class="flex flex-cols">no</div>'


def html_frame(spark, *pages):
    return spark.createDataFrame(
        [(f"https://h/{i}", html, portal, "Casa", 1) for i, (portal, html) in enumerate(pages)],
        "url string, html string, portal string, tipo string, page int",
    )


def records(spark, *pages):
    return [r.asDict() for r in extraction.extract_listings(html_frame(spark, *pages)).collect()]


def test_first_layout(spark):
    full, bare = records(spark, ("chaves", PAGE_A))
    assert full == {
        "preco": "1200000", "tipo": "Casa", "localizacao": "Meireles & Cia", "area": "70",
        "quartos": "3", "vagas": "2", "banheiros": "4", "condo": "1050",
    }
    assert bare == {**dict.fromkeys(full), "tipo": "Casa"}


@pytest.mark.parametrize("portal, page, cards", [("vivareal", PAGE_VIVA, 2), ("zap", PAGE_ZAP, 1)])
def test_second_layout(spark, portal, page, cards):
    got = records(spark, (portal, page))
    assert len(got) == cards
    assert got[0] == {
        "preco": "350000", "tipo": "Casa", "localizacao": "Aldeota", "area": "70", "quartos": "2",
        "banheiros": "1", "vagas": None, "condo": "Cond. R$ 500",
    }
    assert all(r == {**dict.fromkeys(got[0]), "tipo": "Casa"} for r in got[1:])


def test_mixed_portals_in_one_pass(spark):
    pages = [("chaves", PAGE_A), ("ZAP", PAGE_ZAP), ("vivareal", "")]
    assert len(records(spark, *pages)) == 3


def text_list(spark, html, pattern, within=None):
    frame = spark.createDataFrame([(html,)], "h string")
    return frame.select(P.texts(F.col("h"), pattern, within).alias("t")).first().t


def test_text_nodes(spark):
    p = P.element("p")
    assert text_list(spark, "<p>a<b>x</b>c</p><p></p><p> </p>", p) == ["a", "c", " "]
    assert text_list(spark, "<p>a<!-- <p>no</p> -->b<br>c</p>", p) == ["a", "b", "c"]
    assert text_list(spark, "<p>a<i><b>x</b>y</i>c</p><pre>z</pre>", p) == ["a", "c"]
    nested = "<div class='n'></div><div class=\"k\"><div><div><p>1</p></div></div><p>2</p></div><p>3</p>"
    assert text_list(spark, nested, p, P.element("div", ["k"])) == ["1", "2"]
    assert text_list(spark, "<div class=\"k", p, P.element("div", ["k"])) == []


@pytest.mark.parametrize(
    "html, element, within, expected",
    [
        ('<div class="k">' + "<div>" * 7 + "<p>R$ 1</p>" + "</div>" * 7 + "</div><p>no</p>", "p", ("div", ["k"]), ["R$ 1"]),
        ("<p>t<a>X<b>Y<i><u><s><em>deep</em></s></u></i></b></a></p>", "p", None, ["t"]),
        ("<div>a<div>b</div>c</div>", "div", None, ["a", "b", "c"]),
        ("<!-- <p>old</p> --><p>new</p>", "p", None, ["new"]),
        ("<script>var x = '<p>js</p>';</script><p>a</p>", "p", None, ["a"]),
        ("<P CLASS='k'>a</P><p class=k>b</p><p class=kk>no</p>", ("p", ["k"]), None, ["a", "b"]),
        ('<p title="a>b">x</p>', "p", None, ["x"]),
        ("<ul><li>a<li>b</ul>", "li", None, ["a", "b"]),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", "li", None, ["a", "b", "c", "d"]),
        ("<p>a<p>b<div>c</div>", "p", None, ["a", "b"]),
        ("<p>a &lt; b &amp;amp; c</p>", "p", None, ["a < b &amp; c"]),
        ("<p>Coc&oacute; Aracap&#233; m&sup2; &#x1F600; &nope; &#0; R&nbsp;&copy</p>", "p", None,
         ["Cocó Aracapé m² \U0001f600 &nope; \ufffd R\u00a0©"]),
    ],
)
def test_markup_forms(spark, html, element, within, expected):
    kind = P.element(element) if isinstance(element, str) else P.element(*element)
    assert text_list(spark, html, kind, within and P.element(*within)) == expected


def card_texts(spark, html, kind):
    frame = spark.createDataFrame([(html,)], "html string")
    return [r.card for r in P.cards(frame, kind).orderBy("card_no").collect()]


def test_cards_end_at_their_closing_tag(spark):
    k = P.element("div", ["k"])
    one = '<div class="k">a<div>b</div></div>'
    assert card_texts(spark, f"x{one}<p>after</p>{one}<div>z</div>", k) == [one, one]
    outer = f'<div class="k">1{one}2</div>'
    assert card_texts(spark, f"{outer}</div>3", k) == [outer, one]
    assert card_texts(spark, f"<!-- {one} -->{one}", k) == [one]
    assert card_texts(spark, '<div class="k">open', k) == ['<div class="k">open']
    assert card_texts(spark, "<ul><li>a<li>b<ul><li>c</ul></ul>d", P.element("li")) == ["<li>a", "<li>b<ul><li>c</ul>", "<li>c"]
    assert card_texts(spark, "<p>a<b>x</b><p>b</p>c", P.element("p")) == ["<p>a<b>x</b>", "<p>b</p>"]


def test_text_after_a_card_is_not_its_own(spark):
    page = PAGE_ZAP.replace("R$ 350.000", "").replace("<p></p>", "") + '<footer><p><b>R$ 99.999</b></p></footer><h2 data-cy="rp-cardProperty-location-txt">Outside</h2>'
    [row] = records(spark, ("zap", page))
    assert row["localizacao"] == "Aldeota" and row["preco"] != "99999"


def test_unknown_portal_is_reported(spark):
    frame = html_frame(spark, ("other", PAGE_A), ("chaves", PAGE_A))
    assert [tuple(r) for r in extraction.unknown_portals(frame).collect()] == [("other", 1)]
    with pytest.raises(Exception, match="no layout for portal other"):
        extraction.extract_listings(frame).collect()


def test_links_in_all_forms_and_base(spark):
    frame = spark.createDataFrame([("<a href='/x'>1</a><A HREF=/y>2</A><a data-href=\"no\" href=\"/z?a&amp;b\">3</a><!-- <a href='c'> -->",)], "h string")
    assert column(frame.select(P.attributes(F.col("h"), "a", "href").alias("l")), "l") == [["/x", "/y", "/z?a&b"]]
    page = "<head><base href='/deep/down/'></head><a rel='next' href='n.html'>"
    [row] = extraction.follow_links(html_frame(spark, ("chaves", page))).collect()
    assert row.url == "https://h/deep/down/n.html"


def test_class_and_attribute_matching(spark):
    frame = spark.createDataFrame(
        [('<li class="a b-c d">',), ('<li id="x" class="d b-c a">',), ('<li class="a b-cd">',),
         ('<link class="a b-c">',), ('<li data-class="a b-c">',)],
        "h string",
    )
    got = column(frame.select(F.col("h").rlike(P.open_tag("li", ["a", "b-c"])).alias("m")), "m")
    assert got == [True, True, False, False, False]


def test_long_broken_page_is_harmless(spark):
    html = "<div class=\"k\">" + "<p>x<b>" * 3000
    assert text_list(spark, html, P.element("p"), P.element("div", ["k"])) == ["x"] * 3000
    good = "<div class=\"k\">" + "<p>x</p>" * 30000 + "</div>"
    assert len(text_list(spark, good, P.element("p"), P.element("div", ["k"]))) == 30000


@pytest.mark.parametrize(
    "link, expected",
    [
        ("https://x.org/a", "https://x.org/a"),
        ("//x.org/a", "https://x.org/a"),
        ("/a?b=1", "https://h.com/a?b=1"),
        ("?pg=2", "https://h.com/d/e.html?pg=2"),
        ("f.html", "https://h.com/d/f.html"),
        ("../f/./g?x=../y", "https://h.com/f/g?x=../y"),
        ("../../../f", "https://h.com/f"),
        ("..", "https://h.com/"),
        ("#top", "https://h.com/d/e.html?q=1#top"),
        ("", "https://h.com/d/e.html?q=1"),
    ],
)
def test_links_are_resolved(spark, link, expected):
    frame = spark.createDataFrame([("https://h.com/d/e.html?q=1#z", link)], "u string, l string")
    assert column(frame.select(P.resolve(F.col("u"), F.col("l")).alias("r")), "r") == [expected]


def test_next_page(spark):
    frame = html_frame(spark, ("chaves", PAGE_A), ("chaves", "<a rel='x' href='/n'>"))
    [row] = extraction.follow_links(frame).collect()
    assert (row.url, row.page, row.tipo) == ("https://h/lista?pg=2&o=1", 2, "Casa")
    assert extraction.follow_links(frame.withColumn("page", F.lit(99))).count() == 0


def test_addresses(spark):
    seeds = extraction.seed_urls(extraction.portal_table(spark))
    assert seeds.count() == 9
    urls = column(seeds.where("portal = 'zap' and tipo = 'Condomínio'"), "url")
    assert urls == ["https://www.zapimoveis.com.br/venda/casas-de-condominio/ce+fortaleza/"]
    pages = extraction.page_urls(seeds.where("portal = 'vivareal' and tipo = 'Casa'"), 3)
    base = "https://www.vivareal.com.br/venda/ceara/fortaleza/casa_residencial"
    assert column(pages.orderBy("page"), "url") == [base, f"{base}?pagina=2", f"{base}?pagina=3"]
    assert extraction.allowed(seeds).count() == 9
    other = spark.createDataFrame([("https://evilzapimoveis.com.br/",), ("no url",)], "url string")
    assert extraction.allowed(other).count() == 0


def nested(kind, depth, inner):
    return f"<{kind}>" * depth + inner + f"</{kind}>" * depth


@pytest.mark.parametrize("depth", [0, 2, 3, 4])
def test_pattern_and_walk_agree_at_any_depth(spark, depth):
    inner = nested("div", depth, "<p>in</p>") + "<p>own</p>" + nested("div", 1, "<p>more</p>")
    html = f'<div class="k">{inner}</div><p>out</p><div class="k"><p>two</p></div>'
    k, p = P.element("div", ["k"]), P.element("p")
    assert text_list(spark, html, p, k) == ["in", "own", "more", "two"]
    assert card_texts(spark, html, k) == [f'<div class="k">{inner}</div>', '<div class="k"><p>two</p></div>']
    lists = "<ul><li>" * depth + "x" + "</li></ul>" * depth
    assert card_texts(spark, f'<ul><li class="k">a{lists}b</li><li class="k">c</ul>', P.element("li", ["k"])) == [
        f'<li class="k">a{lists}b</li>', '<li class="k">c',
    ]
    # Both ways of reading give the same texts, whatever is unclosed inside.
    broken = ("<b>x</i>y", "<p>x<p>y", "a<br>b<b>c</b>d<li>e<li>f</li>g", "<i>x<div>y</div>z")
    rows = [(f'<div class="k">{nested("div", depth, html)}{html}</div>',) for html in broken]
    frame = spark.createDataFrame(rows, "h string")
    for row in frame.select(P.shown_texts(F.col("h"), k).alias("t"), P._walk(F.col("h"), k).alias("w")).collect():
        assert row.t == row.w


def test_many_text_nodes_cost_linear_time(spark):
    import time

    def seconds(n):
        # Unclosed, so that all tags are walked.
        html = '<div class="k">' + "<p>x<br>y</p>" * n
        start = time.perf_counter()
        assert text_list(spark, html, P.element("p"), P.element("div", ["k"])) == ["x", "y"] * n
        return time.perf_counter() - start

    seconds(100)
    small, large = min(seconds(2_500) for _ in range(2)), seconds(25_000)
    assert large < 20 * small + 2


@pytest.mark.parametrize(
    "text, as_text, as_attribute",
    [
        ("&#00000233;t&#x00000000E9;", "été", "été"),
        ("&#233a &#xE9g", "éa ég", "éa ég"),
        ("&copyright &notit; &notin; &ampx", "©right ¬it; ∉ &x", "&copyright &notit; ∉ &ampx"),
        ("?a=1&copy=2&lt", "?a=1©=2<", "?a=1&copy=2<"),
        ("&#; &#x; &#xg; & &; &1", "&#; &#x; &#xg; & &; &1", "&#; &#x; &#xg; & &; &1"),
        ("&#99999999999999999999; &#x110000; &#xD800;", "� � �", "� � �"),
        ("&#0000000000000000000000065;&#0;", "A�", "A�"),
        ("&frac12&frac123&CounterClockwiseContourIntegral;", "½½3∳", "½&frac123∳"),
    ],
)
def test_character_references(spark, text, as_text, as_attribute):
    from casario.functions import decode_entities

    frame = spark.createDataFrame([(text,)], "t string")
    got = frame.select(decode_entities(F.col("t")).alias("a"), decode_entities(F.col("t"), attribute=True).alias("b")).first()
    assert tuple(got) == (as_text, as_attribute)


def test_empty_unclosed_and_nested_elements_are_told_apart_by_one_pattern(spark):
    p, k = P.element("p"), P.element("div", ["k", "wide"])
    html = '<p></p><p>a</p><p>b<h1>c</h1><div class="k wide">d<div class=\'wide k\'>e</div></div><div class="wide k">f'
    frame = spark.createDataFrame([(html,)], "h string")
    found = frame.select(P._contents(F.col("h"), p).alias("p"), P._contents(F.col("h"), k).alias("k")).first()
    assert found.p == ["", "a", ""] and found.k == ["d<div class='wide k'>e</div>", ""]
    assert text_list(spark, html, p) == ["a", "b"] and text_list(spark, html, k) == ["d", "e", "f"]
    assert text_list(spark, "<p>a</p><p></p>", p) == ["a"] and text_list(spark, "<p>a</p><p>", p) == ["a"]
    assert text_list(spark, "<div>a</div>", p) == [] and text_list(spark, html, p, P.element("p", ["k"])) == []


def test_layouts_are_filled_without_searching_the_page(spark):
    from workload import inputs

    pages = inputs.listing_pages(spark, "/root/testdata/sf0.001")
    assert "{preco}" not in pages._jdf.queryExecution().optimizedPlan().toString()
    assert pages.where(F.col("html").rlike(r"\{[a-z]+\}") | F.col("html").isNull()).count() == 0


def test_cards_of_plain_pages_are_read_in_one_pass(spark):
    k = P.element("div", ["k", "wide"])
    one = '<div id="a>b" class="k wide">a<div>b</div></div>'
    pages = (
        f"<p>x</p>{one}<DIV>z</DIV>{one}",
        f"{one}<!-- {one}", f"{one}<ScripT>{one}", f'<div class="k wide">a<style>b</style></div>{one}',
        f'<div title="<i">{one}', f"<div {one}", f"<div title='> {one}", f"{one}<div",
        f'{one}<div class="k wide">', f'<div class="k wide">{one}</div>', f"wide{one}", "", None,
    )
    frame = spark.createDataFrame([(i, html) for i, html in enumerate(pages)], "i int, h string")
    by_pattern = F.regexp_extract_all("h", F.lit(k.plain), F.lit(1))
    read = P.bind(P.visible(F.col("h")), lambda shown: P._elements(shown, k))
    rows = frame.select(by_pattern.alias("p"), P.card_list(F.col("h"), k).alias("c"), read.alias("r")).orderBy("i").collect()
    assert rows[0].p == [one[1:]] * 2 and rows[0].c == [one] * 2
    assert all("" in row.p for row in rows[1:3] + rows[4:7])
    # Otherwise the marks tell that more may begin than were found.
    assert [len(row.p) for row in rows[7:11]] == [1] * 4 and rows[3].p == [""] and rows[11].p == []
    assert [row.c for row in rows] == [row.r for row in rows]


def test_what_is_bound_is_not_copied(spark):
    frame = spark.createDataFrame([(["a", None],), (None,)], "a array<string>")
    bound = P.bind(F.col("a"), lambda a: F.concat(a, a))
    assert "transform(" not in frame.select(bound)._jdf.queryExecution().optimizedPlan().toString()
    assert column(frame.select(bound.alias("b")), "b") == [["a", None, "a", None], None]


def test_texts_are_read_the_same_with_and_without_marks(spark):
    p = P.element("p")
    assert text_list(spark, "<p>a<!-- x -->&lt;</p><p></p><p>b</p>", p) == ["a", "<", "b"]
    assert text_list(spark, "&amp;<!-- x --><p>a</p><p> </p>", p) == ["a", " "]
    assert [P._from_rarest(text) for text in ("style-module__list", "text-nowrap", "ab", "çé")] == ["__list", "xt-nowrap", "ab", "çé"]
