"""DuckDB SQL with the results that `queries.py` has to reach."""

from __future__ import annotations

from collections.abc import Sequence

from casario.functions.formatting import MONTHS
from casario.functions.text import ORIGINS, UNKNOWN_ORIGIN
from casario.operators.location import CENTRE, REGIONS, SHORE
from casario.operators.pages import BLOCKS
from workload.inputs import MANY, MONTH, PLACES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values: Sequence[str]) -> str:
    return ", ".join(text(value) for value in values)


def half_away(x: str, digits: int = 2) -> str:
    x, scale = f"CAST({x} AS DOUBLE)", 10**digits
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale})"


def brazilian(x: str, pattern: str) -> str:
    return f"translate(format('{pattern}', CAST({x} AS DOUBLE)), ',.', '.,')"


def currency(x: str) -> str:
    return f"'R$ ' || {brazilian(x, '{:,.2f}')}"


def every(n: int) -> str:
    return f"l_orderkey % {n} = 0"


PLACE = f"list_extract([{texts(PLACES)}], n_nationkey + 1)"

RAW = f"""
lines AS (
    SELECT * FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
), priced AS (
    SELECT *, 'R$ ' || replace(format('{{:,}}', CAST(floor(l_extendedprice * 60) AS BIGINT)), ',', '.')
        AS amount
    FROM lines
), dated AS (
    SELECT *, strftime(o_orderdate, '%Y-%m') AS date_ref FROM priced
    UNION ALL
    SELECT *, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m') FROM priced WHERE {every(13)}
), raw AS (
    SELECT
        'portal_' || (l_suppkey % 3) AS origem,
        date_ref,
        p_type AS tipo,
        CASE WHEN NOT {every(101)} THEN {PLACE} || ', ' || r_name END AS localizacao,
        CASE WHEN {every(17)} THEN '60-80'
             WHEN {every(19)} THEN '75.5'
             WHEN {every(23)} THEN '  ' || (p_size * 10) || ' '
             ELSE CAST(p_size * 10 AS VARCHAR) END AS area,
        CAST(l_linenumber AS VARCHAR) AS quartos,
        CAST(l_linenumber % 4 AS VARCHAR) AS banheiros,
        CAST(l_partkey % 12 AS VARCHAR) AS vagas,
        CASE WHEN {every(29)} THEN NULL
             WHEN {every(31)} THEN 'Sob consulta'
             WHEN {every(37)} THEN amount || ',50'
             ELSE amount END AS preco,
        CASE WHEN NOT {every(3)} THEN 'R$ ' || (l_partkey % 900) END AS condo
    FROM dated
)"""


def digits(x: str) -> str:
    return f"replace(replace({x}, 'R$', ''), '.', '')"


TYPED = f"""
typed AS (
    SELECT sha256(origem || tipo || localizacao || area || quartos || banheiros || vagas || preco) AS id,
        * REPLACE (coalesce(TRY_CAST(preco AS FLOAT), 0) AS preco,
                   coalesce(TRY_CAST(condo AS FLOAT), 0) AS condo)
    FROM (
        SELECT * REPLACE (
            split_part(localizacao, ',', 1) AS localizacao,
            coalesce(TRY_CAST(area AS INTEGER), 0) AS area,
            coalesce(TRY_CAST(quartos AS INTEGER), 0) AS quartos,
            coalesce(TRY_CAST(banheiros AS INTEGER), 0) AS banheiros,
            coalesce(TRY_CAST(vagas AS INTEGER), 0) AS vagas,
            {digits('preco')} AS preco,
            {digits('condo')} AS condo)
        FROM raw)
)"""

_FIELDS = "origem, tipo, localizacao NULLS LAST, area, quartos, banheiros, vagas, condo"

MONTHLY = f"""
monthly AS (
    SELECT * FROM typed
    QUALIFY row_number() OVER (PARTITION BY date_ref, id ORDER BY preco DESC, {_FIELDS}) = 1
)"""

PLAUSIBLE = (
    "preco > 65000 AND area BETWEEN 30 AND 1000 AND quartos BETWEEN 1 AND 10 "
    "AND banheiros BETWEEN 1 AND 10 AND vagas BETWEEN 1 AND 10"
)

SILVER = f"""
silver AS (SELECT * FROM monthly WHERE {PLAUSIBLE})"""

OVERALL = f"""
overall AS (
    SELECT * FROM silver
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY preco DESC, date_ref, {_FIELDS}) = 1
)"""

_EDGES = [(1, None, 200_000), (2, 200_001, 500_000), (3, 500_001, 1_000_000),
          (4, 1_000_001, 5_000_000)]


def in_band(low: int | None, high: int) -> str:
    return f"preco <= {high}" if low is None else f"preco BETWEEN {low} AND {high}"


BAND = "CASE {} WHEN preco > 5000000 THEN '5' END".format(
    " ".join(f"WHEN {in_band(low, high)} THEN '{n}'" for n, low, high in _EDGES)
)

REGION_OF = "CASE {} ELSE 'Outro' END".format(
    " ".join(f"WHEN lower(localizacao) IN ({texts(n)}) THEN '{r}'" for r, n in REGIONS.items())
)


def flag(names: Sequence[str]) -> str:
    return f"CASE WHEN lower(localizacao) IN ({texts(names)}) THEN 'Sim' ELSE 'Não' END"


OBT = f"""
obt AS (
    SELECT id, date_ref, tipo, localizacao,
        {REGION_OF} AS secretaria_regional,
        {flag(SHORE)} AS prox_orla,
        {flag(CENTRE)} AS prox_centro,
        {BAND} AS faixa_preco,
        area, quartos, banheiros, vagas, preco, condo,
        preco / area AS preco_m2
    FROM overall
)"""

BAND_COUNTS = ", ".join(
    [f"count(*) FILTER ({in_band(low, high)}) AS faixa_{n}" for n, low, high in _EDGES]
    + ["count(*) FILTER (preco > 5000001) AS faixa_5"]
)


def mart(name: str, by: str, lag_by: str) -> str:
    return f"""
{name}_groups AS (
    SELECT date_ref, {by}, count(*) AS qtd_imoveis, {BAND_COUNTS},
        {half_away('avg(preco)')} AS preco_medio,
        {half_away('avg(preco_m2)')} AS preco_m2_medio,
        CAST({half_away('median(preco)')} AS FLOAT) AS preco_mediano,
        CAST({half_away('median(preco_m2)')} AS FLOAT) AS preco_m2_mediano
    FROM obt GROUP BY date_ref, {by} HAVING count(*) > 20
), {name}_lagged AS (
    SELECT *, lag(preco_m2_mediano) OVER (PARTITION BY {lag_by} ORDER BY date_ref) AS before
    FROM {name}_groups
), {name} AS (
    SELECT * EXCLUDE (before) REPLACE (
        CAST(preco_mediano AS DOUBLE) AS preco_mediano,
        CAST(preco_m2_mediano AS DOUBLE) AS preco_m2_mediano),
        CAST(CAST(CASE WHEN before IS NULL THEN 0
            ELSE {half_away('(preco_m2_mediano - before) / before * 100')} END AS FLOAT) AS DOUBLE)
            AS variacao_m2_pct
    FROM {name}_lagged
)"""


MART_TYPE = mart("mart_type", "tipo", "tipo")
MART_LOCATION = mart("mart_location", "localizacao, secretaria_regional", "localizacao")

_TO_TYPED = [RAW, TYPED]
_TO_SILVER = [*_TO_TYPED, MONTHLY, SILVER]
_TO_OBT = [*_TO_SILVER, OVERALL, OBT]


def sql(ctes: Sequence[str], body: str) -> str:
    return f"WITH {','.join(ctes)}\n{body}"


AS_DOUBLE = "CAST(preco AS DOUBLE) AS preco, CAST(condo AS DOUBLE) AS condo"
COUNTS = "CAST(area AS INTEGER) AS area, quartos, banheiros, vagas"


def movers(direction: str) -> str:
    return sql(
        [*_TO_OBT, MART_LOCATION],
        f"""SELECT localizacao, secretaria_regional, variacao_m2_pct,
            format('{{:.2f}}%', variacao_m2_pct) AS variacao_texto
        FROM mart_location WHERE qtd_imoveis > {MANY} AND date_ref = '{MONTH}'
        ORDER BY variacao_m2_pct {direction} NULLS LAST, localizacao, secretaria_regional LIMIT 5""",
    )


TREND = """
trend AS (
    SELECT date_ref, median(CAST(preco AS DOUBLE)) AS preco_mediano
    FROM {source} WHERE date_ref IS NOT NULL GROUP BY date_ref
), changed AS (
    SELECT *, lag(preco_mediano) OVER (ORDER BY date_ref) AS before FROM trend
)"""

MONTH_LABEL = (
    f"list_extract([{texts(MONTHS)}], CAST(substr(date_ref, 6, 2) AS INTEGER))"
    " || '/' || substr(date_ref, 1, 4)"
)

TREND_ROW = f"""date_ref, {MONTH_LABEL} AS mes, preco_mediano,
    {half_away('(preco_mediano - before) / before * 100')} AS variacao_pct"""


def shares(column: str) -> str:
    return sql(
        _TO_OBT,
        f"""SELECT {column}, count(*) AS n,
            CAST(count(*) AS DOUBLE) / (sum(count(*)) OVER ()) AS share
        FROM obt WHERE {column} IS NOT NULL GROUP BY {column}""",
    )


def leaders() -> str:
    branches = " UNION ALL ".join(
        f"SELECT {n} AS faixa, date_ref, localizacao, faixa_{n} AS total, "
        f"{currency('preco_mediano')} AS preco_mediano FROM mart_location "
        f"WHERE faixa_{n} = (SELECT max(faixa_{n}) FROM mart_location)"
        for n in range(1, 6)
    )
    return sql([*_TO_OBT, MART_LOCATION], branches)


def describe() -> str:
    price = "CAST(preco AS DOUBLE)"
    measures = [
        ("Média", f"avg({price})"),
        ("Desvio Padrão", f"stddev_samp({price})"),
        ("Quartil 1", f"quantile_cont({price}, 0.25)"),
        ("Quartil 2 (Mediana)", "median(preco)"),
        ("Quartil 3", f"quantile_cont({price}, 0.75)"),
        ("Mínimo", f"min({price})"),
        ("Máximo", f"max({price})"),
    ]
    branches = " UNION ALL ".join(
        f"SELECT {i} AS ordem, {text(label)} AS medida, {half_away(f'CAST({x} AS DOUBLE)')} AS resultado FROM obt"
        for i, (label, x) in enumerate(measures, 1)
    )
    return sql(_TO_OBT, f"SELECT *, {currency('resultado')} AS texto FROM ({branches})")


def grouped(ctes: Sequence[str], keys: str, source: str, extra: str = "") -> str:
    return sql(ctes, f"SELECT {keys}, count(*) AS n{extra} FROM {source} GROUP BY {keys}")


def per_value(column: str, columns: str) -> str:
    return sql(
        [RAW], f"SELECT {column}, count(*) AS n, {columns} FROM raw GROUP BY {column}"
    )


def origin_tag() -> str:
    cases = " ".join(
        f"WHEN contains(lower(file_name), {text(key)}) THEN {text(name)}"
        for key, name in ORIGINS.items()
    )
    return f"""SELECT *, CASE {cases} ELSE {text(UNKNOWN_ORIGIN)} END AS origem, '{MONTH}' AS date_ref
    FROM (SELECT s_suppkey, CASE s_suppkey % 4
            WHEN 0 THEN 'a_CHAVES_' || s_name || '.json'
            WHEN 1 THEN s_name || '_VivaReal.json'
            WHEN 2 THEN 'zap-' || s_name || '-chaves.json'
            ELSE s_name || '.json' END AS file_name
        FROM supplier)"""


def extracted() -> str:
    """What the generated portal pages were made from, field by field.

    On two of the portals price and fee are the first and second entry of one list, so
    where the price is missing, the fee stands in its place.
    """
    first = "origem = 'portal_0'"
    trimmed = "split_part(trim(coalesce(localizacao, '')), ',', 1)"
    full = f"""SELECT
        trim({digits(f"CASE WHEN {first} THEN preco ELSE coalesce(preco, condo) END")}) AS preco,
        tipo,
        CASE WHEN {first} THEN split_part(localizacao, ',', 1) ELSE {trimmed} END AS localizacao,
        CASE WHEN {first} THEN area ELSE split_part(area || ' m²', ' ', 1) END AS area,
        quartos, banheiros, vagas,
        CASE WHEN {first} THEN trim({digits('condo')})
             WHEN preco IS NOT NULL THEN condo END AS condo,
        origem, date_ref, 1 AS page FROM raw"""
    bare = f"""SELECT NULL AS preco, tipo,
        CASE WHEN {first} THEN split_part(localizacao, ',', 1) ELSE '' END AS localizacao,
        NULL AS area, NULL AS quartos, NULL AS banheiros, NULL AS vagas, NULL AS condo,
        origem, date_ref, 1 AS page FROM raw"""
    return sql([RAW], f"{full} UNION ALL {bare}")


URL_FOLDER = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(https?://[^/]+.*/)[^/]*$', 1)"
URL_SITE = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
LINKS = """regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1)"""
NAV_TEXTS = (
    "regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '<a[^>]*>([^<]+)</a>', 1)"
)


def decoded(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def oracle_sql() -> dict[str, str]:
    bare_silver = "id, origem, date_ref, tipo, localizacao, area, quartos, banheiros, vagas"
    return {
        "origin_tag": origin_tag(),
        "union_sources": grouped(
            [RAW],
            "origem, tipo, quartos",
            "(SELECT * REPLACE (CASE WHEN origem <> 'portal_0' THEN condo END AS condo) FROM raw)",
            ", count(condo) AS with_fee, count(preco) AS with_price",
        ),
        "bronze": sql([RAW], "SELECT * FROM raw"),
        "adhoc_obt_m2": sql(
            _TO_OBT,
            "SELECT id, date_ref, CAST(preco AS DOUBLE) AS preco, area, "
            "CAST(preco / area AS DOUBLE) AS preco_m2 FROM obt",
        ),
        "feed_lines": sql(
            [RAW],
            """SELECT * REPLACE (CASE WHEN preco = 'Sob consulta' AND TRY_CAST(trim(area) AS INTEGER) IS NOT NULL
                AND area <> '75.5' THEN CAST(CAST(trim(area) AS INTEGER) * 1000 + 1 AS VARCHAR) ELSE preco END AS preco)
            FROM raw""",
        ),
        "audit": sql([RAW], "SELECT count(*) AS n, 0::BIGINT AS sem_data, 1::BIGINT AS datas, true AS passado FROM raw"),
        "folder_tables": "SELECT page_id, split_part(split_part(url, '/', -1), '-', 1) AS tabela FROM pages",
        "seed_urls": """SELECT s_name AS portal, tipo,
            'https://www.' || lower(s_name) || '.example/' || slug || '/venda/' AS url, 1 AS page
            FROM supplier CROSS JOIN (VALUES ('Casa', 'casas'), ('Apartamento', 'apartamentos')) c(tipo, slug)""",
        "page_urls": """SELECT page_id, CAST(page AS INTEGER) AS page, CASE WHEN page = 1 THEN url
            ELSE split_part(url, '?', 1) || '?pagina=' || page END AS url
            FROM pages CROSS JOIN range(1, 51) r(page)""",
        "next_link": f"""SELECT page_id, page + 1 AS page, CASE kind
                WHEN 0 THEN {URL_SITE} || '/lista?pg=' || (page_id + 1) || '&o=1'
                WHEN 1 THEN 'https://www.example.org/p/' || (page_id + 1)
                WHEN 2 THEN split_part(url, ':', 1) || '://cdn.example.org/p/' || (page_id + 1)
                WHEN 3 THEN regexp_replace(url, '[?#].*$', '') || '?pg=' || (page_id + 1)
                WHEN 4 THEN regexp_replace({URL_FOLDER}, '[^/]+/$', '') || (page_id + 1) || '/x.html'
            END AS url
            FROM (SELECT *, page_id % 6 AS kind, CAST(page_id % 100 AS INTEGER) AS page FROM pages)
            WHERE kind < 5 AND page < 99""",
        "page_links": f"""SELECT page_id, len(links) AS n_links, links[1] AS first_link,
            array_to_string(links, ' ') AS links FROM (
            SELECT page_id, list_transform({LINKS}, lambda x: {decoded('x')}) AS links FROM pages)""",
        "host_filter": f"""SELECT page_id, url FROM pages
            WHERE {HOST} LIKE '%.example.com' OR {HOST} IN ('example.com', 'spam-farm.example.org')""",
        "page_cards": rf"""SELECT page_id, tipo, page, CAST(i AS INTEGER) AS card_no,
            '<p>' || body || CASE WHEN starts_with(substr(piece, length(body) + 1), '</p>') THEN '</p>' ELSE '' END AS card
            FROM (
                SELECT *, regexp_extract(piece, '(?s)^(.*?)(?:</?(?:{'|'.join(BLOCKS)})[\s>/]|$)', 1) AS body FROM (
                    SELECT page_id, regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS tipo,
                        coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER), 1) AS page,
                        unnest(range(len(pieces) - 1)) AS i, unnest(pieces[2:]) AS piece
                    FROM (SELECT *, string_split(regexp_replace(html,
                        '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', chr(1), 'g'), '<p>') AS pieces FROM pages)))""",
        "page_texts": f"""SELECT page_id, len(t) AS n_texts, t[2] AS second, t[41] AS out_of_range,
            t[-1] AS last, array_to_string(t, '|') AS texts FROM (
            SELECT page_id, list_transform({NAV_TEXTS}, lambda x: {decoded('x')}) AS t FROM pages)""",
        "page_title": f"""SELECT page_id,
            {decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
            {decoded("nullif(regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1), '')")} AS ad
            FROM pages""",
        "extract_listings": extracted(),
        "first_token": "SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS token FROM part",
        "clean_price": per_value(
            "preco", f"trim({digits('preco')}) AS cleaned, {digits('preco')} AS digits"
        ),
        "clean_location": per_value(
            "localizacao",
            "split_part(localizacao, ',', 1) AS bairro, "
            "split_part(trim(localizacao), ',', 1) AS bairro_sem_espaco, "
            "split_part(localizacao, ',', 1) AS antes",
        ),
        "cast_int": per_value(
            "area",
            "CAST(TRY_CAST(area AS INTEGER) AS BIGINT) AS inteiro, "
            "CAST(coalesce(TRY_CAST(area AS INTEGER), 0) AS BIGINT) AS ou_zero",
        ),
        "cast_real": per_value(
            "preco",
            f"CAST(TRY_CAST({digits('preco')} AS FLOAT) AS DOUBLE) AS numero, "
            f"CAST(coalesce(TRY_CAST({digits('preco')} AS FLOAT), 0) AS DOUBLE) AS ou_zero",
        ),
        "listing_id": sql(
            [RAW],
            "SELECT sha256(origem || tipo || localizacao || area || quartos || banheiros || vagas || preco)"
            " AS id, count(*) AS n FROM raw GROUP BY 1",
        ),
        "format_currency": f"SELECT c_custkey, c_acctbal, {currency('c_acctbal')} AS texto FROM customer",
        "format_number": f"""SELECT c_custkey, c_acctbal, {brazilian('c_acctbal', '{:,.0f}')} AS texto
            FROM customer""",
        "format_percent": f"""SELECT c_custkey, c_acctbal, format('{{:.2f}}%', c_acctbal) AS texto,
            {brazilian('c_acctbal', '{:,.2f}')} || '%' AS texto_br FROM customer""",
        "month_label": sql(
            [RAW], f"SELECT date_ref, count(*) AS n, {MONTH_LABEL} AS mes FROM raw GROUP BY date_ref"
        ),
        "dedup_month": sql(
            [*_TO_TYPED, MONTHLY], f"SELECT {bare_silver}, {AS_DOUBLE} FROM monthly"
        ),
        "plausible": grouped(
            _TO_TYPED,
            "date_ref, tipo, localizacao",
            f"(SELECT * FROM typed WHERE {PLAUSIBLE})",
        ),
        "silver": sql(_TO_SILVER, f"SELECT {bare_silver}, {AS_DOUBLE} FROM silver"),
        "union_months": grouped(_TO_SILVER, "date_ref, origem", "silver"),
        "dedup_all": sql([*_TO_SILVER, OVERALL], f"SELECT {bare_silver}, {AS_DOUBLE} FROM overall"),
        "obt": sql(
            _TO_OBT, f"SELECT * EXCLUDE (preco, condo, preco_m2), {AS_DOUBLE} FROM obt"
        ),
        "region_case": sql(
            _TO_SILVER,
            f"SELECT localizacao, {REGION_OF} AS regiao, count(*) AS n FROM silver GROUP BY ALL",
        ),
        "region_join": sql(
            [
                *_TO_SILVER,
                f"""dim AS (
                    SELECT lower({PLACE}) AS name, r_name, n_nationkey FROM nation
                    JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 3)""",
            ],
            """SELECT localizacao, coalesce(r_name, 'Outro') AS secretaria_regional,
                CASE WHEN n_nationkey % 2 = 0 THEN 'Sim' ELSE 'Não' END AS prox_orla,
                CASE WHEN n_nationkey % 5 = 0 THEN 'Sim' ELSE 'Não' END AS prox_centro,
                count(*) AS n
            FROM silver LEFT JOIN dim ON lower(localizacao) = name GROUP BY ALL""",
        ),
        "price_band": sql(
            _TO_SILVER,
            f"SELECT CAST(preco AS DOUBLE) AS preco, n, {BAND} AS faixa_preco FROM "
            "(SELECT preco, count(*) AS n FROM silver GROUP BY preco)",
        ),
        "band_counts": sql(_TO_OBT, f"SELECT date_ref, {BAND_COUNTS} FROM obt GROUP BY date_ref"),
        "mart_type": sql([*_TO_OBT, MART_TYPE], "SELECT * FROM mart_type"),
        "mart_location": sql([*_TO_OBT, MART_LOCATION], "SELECT * FROM mart_location"),
        "mom_change": sql(
            [
                *_TO_OBT,
                f"""m AS (SELECT tipo, date_ref, CAST({half_away('avg(preco)')} AS FLOAT) AS media
                    FROM obt GROUP BY tipo, date_ref)""",
                "l AS (SELECT *, lag(media) OVER (PARTITION BY tipo ORDER BY date_ref) AS anterior FROM m)",
            ],
            f"""SELECT tipo, date_ref, CAST(media AS DOUBLE) AS media, CAST(anterior AS DOUBLE) AS anterior,
                CAST(CAST(CASE WHEN anterior IS NULL THEN 0
                    ELSE {half_away('(media - anterior) / anterior * 100')} END AS FLOAT) AS DOUBLE)
                    AS variacao_pct FROM l""",
        ),
        "dq_unique": sql(
            _TO_SILVER,
            "SELECT id, count(*) AS n FROM silver WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
        ),
        "dq_not_null": sql(
            _TO_SILVER,
            "SELECT origem, date_ref, tipo, localizacao, area, quartos, banheiros, vagas, "
            f"{AS_DOUBLE} FROM silver WHERE id IS NULL",
        ),
        "filter_listings": sql(
            _TO_OBT,
            f"""SELECT * EXCLUDE (preco, condo, preco_m2), {AS_DOUBLE} FROM obt
            WHERE tipo = 'PROMO' AND localizacao IN ('Meireles', 'ALDEOTA', 'COCÓ', 'Centro')
              AND preco BETWEEN 400000 AND 3000000 AND secretaria_regional = '2'""",
        ),
        "kpis": sql(
            _TO_OBT,
            f"""SELECT *, {brazilian('total', '{:,.0f}')} AS total_texto,
                {currency('preco_medio')} AS preco_medio_texto,
                {currency('preco_mediano')} AS preco_mediano_texto
            FROM (SELECT count(*) AS total, {half_away('avg(preco)')} AS preco_medio,
                {half_away('median(preco)')} AS preco_mediano FROM obt)""",
        ),
        "price_trend": sql(
            [*_TO_OBT, TREND.format(source="obt")], f"SELECT {TREND_ROW} FROM changed"
        ),
        "price_trend_type": sql(
            [*_TO_OBT, TREND.format(source="(SELECT * FROM obt WHERE tipo = 'ECONOMY')")],
            f"SELECT {TREND_ROW} FROM changed",
        ),
        "latest_change": sql(
            [*_TO_OBT, TREND.format(source="obt")],
            f"""SELECT *, {brazilian('variacao_pct', '{:,.2f}')} || '%' AS variacao_texto
            FROM (SELECT {TREND_ROW} FROM changed ORDER BY date_ref DESC LIMIT 1)""",
        ),
        "top_m2": sql(
            _TO_OBT,
            """SELECT localizacao, median(CAST(preco_m2 AS DOUBLE)) AS preco_m2 FROM obt
            WHERE localizacao IS NOT NULL GROUP BY localizacao ORDER BY 2 DESC, 1 LIMIT 5""",
        ),
        "location_rank": sql(
            _TO_OBT,
            f"""SELECT localizacao, {half_away('avg(preco)')} AS preco_medio,
                median(CAST(preco_m2 AS DOUBLE)) AS m2_mediano FROM obt
            WHERE localizacao IS NOT NULL GROUP BY localizacao""",
        ),
        "top_gainers": movers("DESC"),
        "top_losers": movers("ASC"),
        "type_change_table": sql(
            [*_TO_OBT, MART_TYPE],
            f"""SELECT tipo, {currency('preco_mediano')} AS preco_mediano,
                {currency('preco_m2_mediano')} AS preco_m2_mediano,
                format('{{:.2f}}%', variacao_m2_pct) AS variacao
            FROM mart_type WHERE date_ref = '{MONTH}'""",
        ),
        "band_leaders": leaders(),
        "describe_price": describe(),
        "price_bounds": sql(
            _TO_OBT,
            "SELECT CAST(trunc(min(preco)) AS BIGINT) AS preco_min, "
            "CAST(trunc(max(preco)) AS BIGINT) AS preco_max FROM obt",
        ),
        "distinct_values": sql(
            _TO_OBT, "SELECT DISTINCT secretaria_regional FROM obt ORDER BY 1"
        ),
        "band_by_type": sql(
            _TO_OBT,
            "SELECT tipo, faixa_preco, count(preco) AS total FROM obt "
            "WHERE faixa_preco IS NOT NULL GROUP BY tipo, faixa_preco",
        ),
        "share_by_type": shares("tipo"),
        "share_by_band": shares("faixa_preco"),
        "price_hist": sql(
            _TO_OBT,
            """SELECT *, n * 100.0::DOUBLE / (sum(n) OVER (PARTITION BY tipo)) AS pct FROM (
                SELECT tipo, CAST(floor(CAST(preco AS DOUBLE) / 50000) * 50000 AS DOUBLE) AS bin_start,
                    count(*) AS n
                FROM obt WHERE preco <= 1000000 GROUP BY ALL)""",
        ),
        "bar_sum": sql(
            _TO_OBT,
            f"SELECT localizacao, {half_away('sum(CAST(preco AS DOUBLE))')} AS total FROM obt "
            "WHERE localizacao IS NOT NULL GROUP BY localizacao",
        ),
    }
