"""Helpers that several operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Byte tables.  Lower-casing touches A-Z only; every byte of a non-ASCII character counts
#: as a letter of an alphanumeric word.
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
ALNUM = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (b + 32 if 65 <= b <= 90 else b) in _KEEP else 32
    for b in range(256)
)


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of digits, letters and non-ASCII characters, in UTF-8."""
    return text.translate(ALNUM).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased.  Exactly space and \\t to \\r split."""
    return text.lower().split() if text else []


#: A key with more than one in so many rows of a join is dealt to several tasks, SALTS of them.
HOT_PARTS = 1000
SALTS = 64


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Where none is set, a temporary one is made if
    they are one process; other executors would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="casario-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage and survives lost executors."""
    path = f"{shared_folder(frame.sparkSession)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def struct_udf(scan: Callable[[list], Iterator[tuple]], schema: str) -> Callable[..., Column]:
    """A vectorised function from a column of texts to a struct of one tuple per text.

    `scan` gets the texts of a batch (None for null) and yields a tuple for each, in order.
    """
    names = StructType.fromDDL(schema).names

    @F.pandas_udf(schema)
    def apply(texts: pd.Series) -> pd.DataFrame:
        values = [None if x is None else x for x in texts]
        return pd.DataFrame(list(scan(values)), columns=names).astype(object)

    return apply


def findings(docs: DataFrame, column: Column, doc_id: str = "doc_id") -> DataFrame:
    """The id and the fields of a struct column; other columns of `docs` are not read."""
    return docs.select(F.col(doc_id), column.alias("_found")).select(F.col(doc_id), "_found.*")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """`docs` as one struct column `doc`, so that no name of its columns clashes with ours."""
    return docs.select(F.struct("*").alias("doc"), *(c.alias(name) for name, c in columns.items()))


def unpacked(frame: DataFrame, like: DataFrame, *more: str) -> DataFrame:
    """The columns of `like` out of `doc`, and `more`; these replace columns of the same name."""
    taken = {name.lower() for name in more}
    return frame.select(*(F.col("doc")[c].alias(c) for c in like.columns if c.lower() not in taken), *more)


def dealt_join(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, salt: Column) -> DataFrame:
    """`rows` with the columns of `keyed`, a written table with a row per key and, in `weight`, the
    number of rows that have it; `salt` is a number that deals out the rows of hot keys."""
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_PARTS > total
    few = keyed.filter(hot).select(*(F.col(k).alias(f"_{k}") for k in keys), F.lit(True).alias("_hot"))
    # At most HOT_PARTS keys are hot.
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    salted = rows.join(F.broadcast(few), same, "left").drop(*(f"_{k}" for k in keys))
    salted = salted.withColumn("_salt", F.when(F.col("_hot"), F.pmod(salt, F.lit(SALTS)).cast("int")).otherwise(0)).drop("_hot")
    copies = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return salted.join(keyed.withColumn("_salt", copies).drop(weight), [*keys, "_salt"]).drop("_salt")
