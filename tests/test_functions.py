from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from casario import functions as C
from helpers import column


def values(spark, expression, inputs, ddl="string"):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {ddl}")
    return column(frame.orderBy("i").select(expression(F.col("x")).alias("y")), "y")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("70", 70), (" 70 ", 70), ("75.5", 76), ("-0.5", -1), ("12.5", 13), ("1e2", 100),
        ("5.", 5), (".5", 1), ("+7", 7), ("60-80", None), ("100f", None), ("1_000", None),
        ("nan", None), ("Infinity", None), ("", None), (None, None), ("99999999999", None),
        ("2147483647.6", None), ("1e400", None),
    ],
)
def test_text_to_int(spark, text, expected):
    assert values(spark, C.try_int, [text]) == [expected]


def test_text_to_real(spark):
    texts = ["350000", " 16777217", "1.5", "350000,50", "Sob consulta", "nan", None, "1d"]
    got = values(spark, C.try_real, texts)
    assert got == [350000.0, 16777216.0, 1.5, None, None, None, None, None]


def test_rounding_is_half_away_from_zero(spark):
    got = values(spark, C.round_half_away, [2.345, 1.005, -1.125, 0.0, None], "double")
    assert got == [2.35, 1.0, -1.13, 0.0, None]


def test_rounding_leaves_large_numbers(spark):
    large = [1e17, -1e17, 1e20, 3e38, -3e38, 92233720368547758.5, 2.0**53]
    assert values(spark, C.round_half_away, large, "double") == large


def test_prices(spark):
    texts = ["R$ 1.200.000", " R$ 350.000 ", "", None, "Sob consulta"]
    assert values(spark, C.clean_price, texts) == ["1200000", "350000", None, None, "Sob consulta"]
    assert values(spark, C.price_digits, ["R$ 350.000", ""]) == [" 350000", ""]


def test_locations(spark):
    texts = ["Aldeota, Fortaleza", " Centro , x", "", None]
    assert values(spark, C.clean_location, texts) == ["Aldeota", " Centro ", None, None]
    assert values(spark, lambda x: C.clean_location(x, trim=True), texts) == [
        "Aldeota", "Centro ", "", None,
    ]
    assert values(spark, C.before_comma, texts) == ["Aldeota", " Centro ", "", None]


def test_first_token_and_query(spark):
    assert values(spark, C.first_token, ["70 m²", "70", " 70", None]) == ["70", "70", "", None]
    assert values(spark, C.strip_query, ["a?b?c", "a"]) == ["a", "a"]


def test_origin_by_file_name(spark):
    names = ["a_chaves.json", "B_ZAP.json", "other.json", "zap-chaves.json", "VivaReal_1.json"]
    assert values(spark, C.origin_of, names) == [
        "Chaves na Mão", "ZAP Imóveis", "Origem Desconhecida", "Chaves na Mão", "Viva Real",
    ]


def test_identity_has_no_separator_and_takes_nulls(spark):
    frame = spark.createDataFrame([("1", "12"), ("11", "2"), ("1", None)], "a string, b string")
    got = column(frame.select(C.listing_id(F.col("a"), F.col("b")).alias("id")), "id")
    assert got[0] == got[1] == hashlib.sha256(b"112").hexdigest()
    assert got[2] is None


@pytest.mark.parametrize(
    "price, label, counter",
    [
        (200000.0, "1", 1), (200000.5, None, None), (200001.0, "2", 2), (500000.0, "2", 2),
        (500001.0, "3", 3), (1000000.0, "3", 3), (1000001.0, "4", 4), (5000000.0, "4", 4),
        (5000001.0, "5", None), (5000002.0, "5", 5), (None, None, None),
    ],
)
def test_price_bands(spark, price, label, counter):
    frame = spark.createDataFrame([(price,)], "p float")
    [row] = frame.select(C.price_band(F.col("p")).alias("label")).collect()
    assert row.label == label
    [counts] = frame.agg(*C.band_counts(F.col("p"))).collect()
    assert list(counts) == [int(i == counter) for i in range(1, 6)]


def test_brazilian_numbers(spark):
    assert values(spark, C.format_currency, [1234567.891, -1234.5, None], "double") == [
        "R$ 1.234.567,89", "R$ -1.234,50", None,
    ]
    assert values(spark, C.format_integer, [2.5, 3.5, 1234567.0], "double") == ["2", "4", "1.234.567"]
    assert values(spark, C.format_percent, [0.125, -15.0, 1234.5], "double") == [
        "0.12%", "-15.00%", "1234.50%",
    ]
    brazilian = lambda x: C.format_percent(x, brazilian=True)
    assert values(spark, brazilian, [1234.5, -4.01], "double") == ["1.234,50%", "-4,01%"]


def test_month_labels(spark):
    got = values(spark, C.month_label, ["2025-04", "2031-12", "2025-13", "maio", None])
    assert got == ["Abril/2025", "Dezembro/2031", "2025-13", "maio", None]


def test_percent_change(spark):
    frame = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    got = column(frame.select(C.percent_change(F.col("a"), F.col("b")).alias("y")), "y")
    assert got[0] == pytest.approx(10.0) and got[1:] == [None, None]
