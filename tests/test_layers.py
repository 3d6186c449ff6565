from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casario.functions.features import ID_FIELDS
from casario.operators import (
    enrich_location,
    filter_listings,
    neighbourhoods,
    not_null,
    region_case,
    union_by_name,
    unique,
)
from casario.operators.location import REGIONS
from casario.plans import layers
from casario.schema import OBT, SILVER
from helpers import column, listings, silver_rows


def one(spark, **change):
    rows = layers.silver(listings(spark, change)).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize("area, expected", [("75.5", 76), ("1e2", 100), (" 70 ", 70)])
def test_area_text(spark, area, expected):
    assert one(spark, area=area).area == expected


@pytest.mark.parametrize(
    "change",
    [
        {"area": "60-80"}, {"area": "100f"}, {"area": "1_000"}, {"area": None}, {"area": "29"},
        {"area": "1001"}, {"quartos": "0"}, {"banheiros": "11"}, {"vagas": None},
        {"preco": "R$ 350.000,50"}, {"preco": "Sob consulta"}, {"preco": "nan"},
        {"preco": "Infinity"}, {"preco": None}, {"preco": "65000"},
    ],
)
def test_implausible_rows_go(spark, change):
    assert one(spark, **change) is None


def test_price_limits_and_precision(spark):
    assert one(spark, preco="65001").preco == 65001.0
    assert one(spark, preco="16777217").preco == 16777216.0
    assert one(spark, condo="Cond. R$ 500").condo == 0.0
    assert one(spark, condo="R$ 1.500").condo == 1500.0


@pytest.mark.parametrize("text, name", [("Aldeota, Fortaleza", "Aldeota"), ("", ""), (None, None)])
def test_location_text(spark, text, name):
    assert one(spark, localizacao=text).localizacao == name


def test_rows_without_identity_collapse_to_the_dearest_per_month(spark):
    raw = listings(
        spark,
        {"localizacao": None, "preco": "300000"},
        {"localizacao": None, "preco": "400000"},
        {"localizacao": None, "preco": "90000", "date_ref": "2025-05"},
    )
    rows = layers.silver(raw).orderBy("date_ref").collect()
    assert [(r.id, r.preco) for r in rows] == [(None, 400000.0), (None, 90000.0)]
    assert column(layers.obt(layers.silver(raw)), "preco") == [400000.0]


def test_identity_collision_keeps_one_before_the_filter(spark):
    raw = listings(
        spark,
        {"area": "45", "quartos": "1", "banheiros": "12"},
        {"area": "45", "quartos": "11", "banheiros": "2"},
    )
    typed = layers.typed(raw)
    assert len(set(column(typed, "id"))) == 1
    assert layers.dedup_month(typed).count() == 1


def test_filter_comes_after_the_choice(spark):
    # Same identity; the first in the order fails the filter and the other is not promoted.
    raw = listings(
        spark,
        {"area": "45", "quartos": "1", "banheiros": "12", "vagas": "3"},
        {"area": "45", "quartos": "11", "banheiros": "2", "vagas": "3"},
        {"area": "451", "quartos": "1", "banheiros": "2", "vagas": "3"},
    )
    typed = layers.typed(raw)
    assert len(set(column(typed, "id"))) == 1
    assert layers.plausible(typed).count() == 1
    assert layers.silver(raw).count() == 0


def test_silver_of_repeated_input_is_the_same(spark):
    raw = listings(spark, {}, {"tipo": "Apartamento"}, {"date_ref": "2025-05"}, {"localizacao": None})
    once = layers.silver(raw)
    twice = layers.silver(union_by_name([raw, raw]))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert once.schema.fieldNames() == SILVER.fieldNames()
    assert [f.dataType for f in once.schema] == [f.dataType for f in SILVER]


def test_across_months_the_earliest_stays(spark):
    raw = listings(spark, {"date_ref": "2025-06"}, {"date_ref": "2025-04"}, {"date_ref": "2025-05"})
    gold = layers.obt(layers.silver(raw))
    assert column(gold, "date_ref") == ["2025-04"]
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in OBT]


def test_month_key_alone_for_a_single_month(spark):
    raw = listings(spark, {}, {}, {"preco": "R$ 400.000"})
    assert layers.silver(raw, keys=("id",)).count() == layers.silver(raw).count() == 2


@pytest.mark.parametrize(
    "name, expected",
    [
        ("MEIRELES", ("2", "Sim", "Sim")),
        ("Messejana", ("6", "Não", "Não")),
        ("Joaquim Tavora", ("Outro", "Não", "Sim")),
        (" Centro", ("Outro", "Não", "Não")),
        (None, ("Outro", "Não", "Não")),
    ],
)
def test_enrichment(spark, name, expected):
    frame = spark.createDataFrame([(name,)], "localizacao string")
    [row] = enrich_location(frame).collect()
    assert (row.secretaria_regional, row.prox_orla, row.prox_centro) == expected
    assert column(frame.select(region_case(F.col("localizacao")).alias("r")), "r") == [expected[0]]


def test_dimension(spark):
    dim = neighbourhoods(spark)
    assert dim.count() == 141 and dim.select("name").distinct().count() == 141
    assert dim.where("shore").count() == 14 and dim.where("centre").count() == 11
    assert [len(names) for names in REGIONS.values()] == [10, 13, 14, 14, 5, 16, 17, 12, 7, 13, 16, 3]


def test_own_dimension(spark):
    dim = spark.createDataFrame(
        [("centro", "X", True, False)], "name string, region string, shore boolean, centre boolean"
    )
    frame = spark.createDataFrame([("Centro",), ("Aldeota",)], "localizacao string")
    got = {r.localizacao: r.secretaria_regional for r in enrich_location(frame, dim).collect()}
    assert got == {"Centro": "X", "Aldeota": "Outro"}


def months(spark, *groups, **common):
    """`n` listings per (month, n, price)."""
    rows = [
        {"date_ref": month, "preco": price, **common}
        for month, n, price in groups
        for _ in range(n)
    ]
    return layers.enrich_location(silver_rows(spark, *rows))


def test_change_skips_a_month_with_too_few_listings(spark):
    gold = months(
        spark, ("2025-04", 21, 300000.0), ("2025-05", 20, 999000.0), ("2025-06", 21, 330000.0)
    )
    rows = layers.mart_tipo(gold).orderBy("date_ref").collect()
    assert [(r.date_ref, r.qtd_imoveis, r.variacao_m2_pct) for r in rows] == [
        ("2025-04", 21, 0.0), ("2025-06", 21, 10.0),
    ]
    assert rows[0].faixa_2 == 21 and rows[0].preco_m2_mediano == 3000.0


def test_mart_types_and_null_group(spark):
    gold = months(spark, ("2025-04", 22, 300000.0), localizacao=None)
    mart = layers.mart_localizacao(gold)
    assert dict(mart.dtypes) == {
        "date_ref": "string", "localizacao": "string", "secretaria_regional": "string",
        "qtd_imoveis": "bigint", **{f"faixa_{i}": "bigint" for i in range(1, 6)},
        "preco_medio": "double", "preco_m2_medio": "double", "preco_mediano": "float",
        "preco_m2_mediano": "float", "variacao_m2_pct": "float",
    }
    [row] = mart.collect()
    assert (row.localizacao, row.secretaria_regional, row.qtd_imoveis) == (None, "Outro", 22)
    assert row.preco_mediano == 300000.0


def test_bands_and_gaps_add_up(spark):
    prices = [100000.0, 200000.5, 300000.0, 600000.0, 2000000.0, 5000001.0, 6000000.0] * 4
    gold = months(spark, *[("2025-04", 1, p) for p in prices])
    [row] = layers.mart_tipo(gold).collect()
    assert [row[f"faixa_{i}"] for i in range(1, 6)] == [4, 4, 4, 4, 4]
    assert row.qtd_imoveis == 28


def test_filters(spark):
    gold = layers.enrich_location(
        silver_rows(
            spark, {"tipo": "Casa"}, {"tipo": "Apartamento", "preco": 500000.0},
            {"localizacao": "Aldeota", "preco": 900000.5}, {"localizacao": None},
        )
    )
    count = lambda **f: filter_listings(gold, **f).count()
    assert count() == count(tipo="Todos", region="Todos", locations=[]) == 4
    assert count(tipo="Casa") == 3
    assert count(locations=["Aldeota", "Centro"]) == 3
    assert count(region="2") == 1
    assert count(price_min=300000, price_max=500000) == 3
    assert count(price_max=900000) == 3
    assert filter_listings(gold.drop("secretaria_regional"), region="2").count() == 4


def test_quality_checks(spark):
    frame = silver_rows(spark, {"id": "a"}, {"id": "a"}, {"id": "b"}, {"id": None}, {"id": None})
    assert [tuple(r) for r in unique(frame, "id").collect()] == [("a", 2)]
    assert not_null(frame, "id").count() == 2


def test_identity_is_told_from_raw_columns(spark):
    import itertools

    names = [*ID_FIELDS, "condo", "date_ref"]
    changes = [dict.fromkeys(gone) for k in (0, 1, 2) for gone in itertools.combinations(names, k)]
    odd = [{name: text} for name in names for text in ("", "x", "R$", ",")]
    rows = layers.bronze(listings(spark, *changes, *odd))
    named = layers.typed(rows.where(layers.has_identity()))
    nameless = layers.typed(rows.where(~layers.has_identity()))
    assert named.count() and named.where("id is null").count() == 0
    assert nameless.count() and nameless.where("id is not null").count() == 0
    assert named.count() + nameless.count() == rows.count()
