"""Small inputs for the hand-made cases."""

from __future__ import annotations

from casario.schema import RAW

LISTING = {
    "origem": "p", "date_ref": "2025-04", "tipo": "Casa", "localizacao": "Aldeota, Fortaleza",
    "area": "70", "quartos": "2", "banheiros": "2", "vagas": "2",
    "preco": "R$ 350.000", "condo": "R$ 500",
}


def listings(spark, *changes: dict):
    rows = [tuple({**LISTING, **change}[name] for name in RAW.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, RAW)


SILVER_DDL = (
    "id string, origem string, date_ref string, tipo string, localizacao string, area int, "
    "quartos int, banheiros int, vagas int, preco float, condo float"
)


def silver_rows(spark, *changes: dict):
    base = {
        "id": None, "origem": "p", "date_ref": "2025-04", "tipo": "Casa", "localizacao": "Centro",
        "area": 100, "quartos": 2, "banheiros": 2, "vagas": 2, "preco": 300000.0, "condo": 0.0,
    }
    rows = []
    for i, change in enumerate(changes):
        row = {**base, "id": f"id{i}", **change}
        rows.append(tuple(row[c.split(" ")[0]] for c in SILVER_DDL.split(", ")))
    return spark.createDataFrame(rows, SILVER_DDL)


def column(df, name):
    return [row[name] for row in df.collect()]
