"""Region and proximity of a neighbourhood."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Neighbourhood names by administrative region, matched in lower case.
REGIONS = {
    "1": [
        "vila velha", "barra do ceará", "cristo redentor", "pirambu",
        "jardim guanabara", "jardim iracema", "floresta", "álvaro weyne",
        "carlito pamplona", "jacarecanga",
    ],
    "2": [
        "meireles", "aldeota", "joaquim távora", "dionísio torres", "dionisio torres",
        "tauape", "são joão do tauape", "varjota", "mucuripe", "vicente pinzon",
        "de lourdes", "papicu", "cais do porto",
    ],
    "3": [
        "quintino cunha", "antônio bezerra", "olavo oliveira", "padre andrade",
        "presidente kennedy", "ellery", "vila ellery", "são gerardo", "parquelândia",
        "amadeu furtado", "rodolfo teófilo", "parque araxá", "farias brito",
        "monte castelo",
    ],
    "4": [
        "benfica", "josé bonifácio", "fátima", "damas", "jardim américa",
        "bom futuro", "parreão", "vila união", "aeroporto", "itaoca", "paraganba",
        "vila peri", "montese", "parangaba",
    ],
    "5": ["bonsucesso", "granja portugal", "bom jardim", "siqueira", "granja lisboa"],
    "6": [
        "alto da balança", "aerolândia", "jardim das oliveiras",
        "cidade dos funcionários", "parque manibura", "parque iracema", "cambeba",
        "josé de alencar", "messejana", "curió", "guajeru", "guajerú",
        "lagoa redonda", "coaçu", "são bento", "paupina",
    ],
    "7": [
        "sabiaguaba", "lagoa sapiranga (coité)", "sapiranga", "coité",
        "edson queiroz", "manuel dias branco", "manoel dias branco",
        "praia do futuro i", "praia do futuro ii", "praia do futuro",
        "engenheiro luciano cavalcante", "salinas", "guararapes", "cocó", "dunas",
        "cidade 2000", "patriolino ribeiro",
    ],
    "8": [
        "serrinha", "dias macêdo", "dias macedo", "boa vista", "castelão",
        "boa vista castelão", "passaré", "prefeito josé walter",
        "planalto ayrton senna", "parque dois irmãos", "dendê", "itaperi",
    ],
    "9": [
        "cajazeiras", "barroso", "jangurussu", "parque santa maria", "ancuri",
        "pedras", "conjunto palmeiras",
    ],
    "10": [
        "maraponga", "jardim cearense", "mondubim", "aracapé", "aracape",
        "parque presidente vargas", "parque santa rosa", "conjunto esperança",
        "novo mondubim", "manoel sátiro", "manuel sátiro", "parque são josé",
        "canindezinho",
    ],
    "11": [
        "couto fernandes", "bela vista", "panamericano", "demócrito rocha",
        "democrito rocha", "pici", "jóquei clube", "henrique jorge", "joao xxiii",
        "joão xxiii", "dom lustosa", "autran nunes", "genibau", "conjunto ceará i",
        "conjunto ceará ii", "conjunto ceará",
    ],
    "12": ["centro", "moura brasil", "praia de iracema"],
}

# Neighbourhoods by the shore.
SHORE = [
    "centro", "moura brasil", "praia de iracema", "barra do ceará",
    "cristo redentor", "pirambu", "meireles", "mucuripe", "cais do porto",
    "vicente pinzon", "praia do futuro", "praia do futuro i", "praia do futuro ii",
    "sabiaguaba",
]

# Neighbourhoods by the city centre.
CENTRE = [
    "centro", "moura brasil", "praia de iracema", "jacarecanga", "farias brito",
    "benfica", "josé bonifácio", "joaquim távora", "joaquim tavora", "aldeota",
    "meireles",
]

# Labels.
OTHER_REGION, YES, NO = "Outro", "Sim", "Não"


def neighbourhoods(spark: SparkSession) -> DataFrame:
    """The dimension behind the lists above: name, region, shore, centre."""
    region_of = {name: region for region, names in REGIONS.items() for name in names}
    names = list(dict.fromkeys([*region_of, *SHORE, *CENTRE]))
    table = pa.table(
        {
            "name": names,
            "region": [region_of.get(name) for name in names],
            "shore": [name in SHORE for name in names],
            "centre": [name in CENTRE for name in names],
        }
    )
    return spark.createDataFrame(table)


def region_case(location: Column) -> Column:
    """Region label as membership tests, for use without the dimension."""
    name = F.lower(location)
    tests = [F.when(name.isin(names), F.lit(region)) for region, names in REGIONS.items()]
    return F.coalesce(*tests, F.lit(OTHER_REGION))


def enrich_location(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Add region and proximity flags by lower-cased neighbourhood.

    The built-in dimension has a fixed size and is broadcast.  One passed in has no
    known bound, so there the join strategy is left to Spark's own size check and to
    adaptive execution, which also splits a neighbourhood with very many listings.
    Of several rows for a name in `dim` the smallest counts, so no listing is multiplied.
    """
    if dim is None:
        dim = F.broadcast(neighbourhoods(df.sparkSession))
    else:
        one = F.min(F.struct("region", "shore", "centre")).alias("one")
        dim = dim.groupBy("name").agg(one).select("name", "one.*")
    flag = lambda name: F.when(F.col(name), F.lit(YES)).otherwise(F.lit(NO))
    joined = df.join(dim, F.lower(df["localizacao"]) == dim["name"], "left")
    return joined.select(
        *[df[name] for name in df.columns],
        F.coalesce(F.col("region"), F.lit(OTHER_REGION)).alias("secretaria_regional"),
        flag("shore").alias("prox_orla"),
        flag("centre").alias("prox_centro"),
    )
