from __future__ import annotations

from casario.operators import enrich_location
from casario.plans import layers, report
from helpers import column, silver_rows


def gold(spark, *changes):
    return layers.obt(silver_rows(spark, *changes))


def mart_frame(spark, *rows):
    ddl = (
        "date_ref string, localizacao string, secretaria_regional string, qtd_imoveis bigint, "
        "faixa_1 bigint, faixa_2 bigint, faixa_3 bigint, faixa_4 bigint, faixa_5 bigint, "
        "preco_mediano float, variacao_m2_pct float"
    )
    return spark.createDataFrame(rows, ddl)


def test_kpis(spark):
    frame = gold(spark, {"preco": 100000.0}, {"preco": 200000.0}, {"preco": 900001.0})
    [row] = report.kpis(frame).collect()
    assert (row.total, row.preco_medio, row.preco_mediano) == (3, 400000.33, 200000.0)
    assert row.preco_medio_texto == "R$ 400.000,33"
    [nothing] = report.kpis(frame.where("preco < 0")).collect()
    assert (nothing.total, nothing.preco_mediano) == (0, None)


def test_trend_drops_null_months_and_compares_with_the_month_before(spark):
    frame = gold(
        spark,
        {"date_ref": "2025-04", "preco": 100000.0}, {"date_ref": "2025-04", "preco": 300000.0},
        {"date_ref": "2025-06", "preco": 250000.0}, {"date_ref": None, "preco": 1.0},
    )
    rows = report.price_trend(frame).orderBy("date_ref").collect()
    assert [(r.mes, r.preco_mediano, r.variacao_pct) for r in rows] == [
        ("Abril/2025", 200000.0, None), ("Junho/2025", 250000.0, 25.0),
    ]
    [last] = report.latest_change(frame).collect()
    assert (last.date_ref, last.variacao_texto) == ("2025-06", "25,00%")


def test_one_month_has_no_change(spark):
    [row] = report.latest_change(gold(spark, {})).collect()
    assert row.variacao_pct is None and row.variacao_texto is None


def test_top_m2_breaks_ties_by_name(spark):
    frame = gold(
        spark,
        *[{"localizacao": name, "preco": 500000.0} for name in ("f", "b", "d", "a", "e", "c")],
        {"localizacao": None, "preco": 9e6},
    )
    assert column(report.top_m2(frame), "localizacao") == ["a", "b", "c", "d", "e"]
    assert column(report.location_rank(frame, k=2), "localizacao") == ["a", "b"]
    assert report.location_rank(frame, k=None).count() == 6


def test_movers(spark):
    mart = mart_frame(
        spark,
        *[("2025-06", name, "1", n, 0, 0, 0, 0, 0, 1.0, change)
          for name, n, change in (("a", 59, 5.0), ("b", 58, 99.0), ("c", 60, -3.5),
                                  ("d", 60, 5.0), ("e", 60, None))],
        ("2025-05", "x", "1", 90, 0, 0, 0, 0, 0, 1.0, 50.0),
    )
    up = report.movers(mart, "2025-06", k=3).collect()
    assert [(r.localizacao, r.variacao_texto) for r in up] == [
        ("a", "5.00%"), ("d", "5.00%"), ("c", "-3.50%"),
    ]
    down = report.movers(mart, "2025-06", rising=False).collect()
    assert [r.localizacao for r in down] == ["c", "a", "d", "e"]


def test_band_leaders_keep_ties(spark):
    mart = mart_frame(
        spark,
        ("2025-04", "a", "1", 30, 7, 1, 0, 0, 0, 100.0, 0.0),
        ("2025-05", "a", "1", 30, 7, 2, 0, 0, 1, 200.0, 0.0),
        ("2025-05", "b", "1", 30, 3, 9, 4, 0, 0, 300.0, 0.0),
    )
    got = sorted((r.faixa, r.date_ref, r.localizacao, r.total) for r in report.band_leaders(mart).collect())
    assert got == [
        (1, "2025-04", "a", 7), (1, "2025-05", "a", 7), (2, "2025-05", "b", 9),
        (3, "2025-05", "b", 4), (4, "2025-04", "a", 0), (4, "2025-05", "a", 0),
        (4, "2025-05", "b", 0), (5, "2025-05", "a", 1),
    ]


def test_description(spark):
    frame = gold(spark, *[{"preco": p} for p in (100000.0, 200000.0, 300000.0, 400000.0)])
    rows = report.describe_price(frame).orderBy("ordem").collect()
    assert [(r.medida, r.resultado) for r in rows] == [
        ("Média", 250000.0), ("Desvio Padrão", 129099.44), ("Quartil 1", 175000.0),
        ("Quartil 2 (Mediana)", 250000.0), ("Quartil 3", 325000.0),
        ("Mínimo", 100000.0), ("Máximo", 400000.0),
    ]
    assert rows[1].texto == "R$ 129.099,44"


def test_type_table(spark):
    frame = enrich_location(silver_rows(spark, *[{"tipo": t} for t in ("Casa", "Loja") for _ in range(21)]))
    table = report.type_change_table(layers.mart_tipo(frame), "2025-04", ["Casa"])
    [row] = table.collect()
    assert tuple(row) == ("Casa", "R$ 300.000,00", "R$ 3.000,00", "0.00%")


def test_small_distributions(spark):
    frame = gold(
        spark, {"preco": 100000.0}, {"preco": 300000.0}, {"preco": 7e6, "localizacao": "Cambeba"},
        {"preco": 200000.5},
    )
    assert sorted(tuple(r) for r in report.band_by_type(frame).collect()) == [
        ("Casa", "1", 1), ("Casa", "2", 1), ("Casa", "5", 1),
    ]
    assert tuple(report.price_bounds(frame).first()) == (100000, 7000000)
    assert column(report.price_histogram(frame), "n") and sum(
        column(report.price_histogram(frame), "n")
    ) == 3


def test_choices_sort_as_text(spark):
    frame = spark.createDataFrame([("2",), ("10",), ("Outro",), ("2",)], "secretaria_regional string")
    assert column(report.distinct_values(frame, "secretaria_regional"), "secretaria_regional") == [
        "10", "2", "Outro",
    ]
