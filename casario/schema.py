"""Column layouts of the listing tables, layer by layer."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


# What a portal feed carries.  Everything stays text on read, so that the type of
# a column never depends on which values happen to be in a file.
FEED = T.StructType(
    _fields(
        T.StringType(),
        "preco", "tipo", "localizacao", "area", "quartos", "banheiros", "vagas", "condo",
    )
)

RAW = T.StructType([*FEED.fields, *_fields(T.StringType(), "origem", "date_ref")])

SILVER = T.StructType(
    [
        *_fields(T.StringType(), "id", "origem", "date_ref", "tipo", "localizacao"),
        *_fields(T.IntegerType(), "area", "quartos", "banheiros", "vagas"),
        *_fields(T.FloatType(), "preco", "condo"),
    ]
)

OBT = T.StructType(
    [
        *_fields(T.StringType(), "id", "date_ref", "tipo", "localizacao"),
        *_fields(T.StringType(), "secretaria_regional", "prox_orla", "prox_centro", "faixa_preco"),
        *_fields(T.IntegerType(), "area", "quartos", "banheiros", "vagas"),
        *_fields(T.FloatType(), "preco", "condo"),
    ]
)

# Bronze column order.
BRONZE_COLUMNS = [
    "origem", "date_ref", "tipo", "localizacao",
    "area", "quartos", "banheiros", "vagas", "preco", "condo",
]

AUDIT = "ingestion_timestamp"
