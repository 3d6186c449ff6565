"""Catalog tables: write, replace a month, query."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed value: the folder name of a NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def save_table(
    df: DataFrame,
    db: str,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> int:
    """Create the database if needed, replace the table, return the rows written.

    The rows are counted while they are written.  They are written beside the old table, which is
    only put aside when they are complete: a job that fails leaves the old rows, and `df` may read
    the table that it replaces.
    """
    spark, table = df.sparkSession, f"{db}.{name}"
    # A new name each time: tasks of a failed job may still be writing to the last one's folder.
    beside, aside = f"{table}__{uuid.uuid4().hex[:8]}", f"{table}__last"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if spark.catalog.tableExists(aside) and not spark.catalog.tableExists(table):
        # An earlier call was stopped between the two renamings.
        _rename(spark, aside, table)
    counted, seen = _counted(df)
    writer = counted.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
    writer.saveAsTable(beside)
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    if spark.catalog.tableExists(table):
        _rename(spark, table, aside)
    _rename(spark, beside, table)
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    return seen.get["rows"]


def _literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _rename(spark: SparkSession, table: str, new_name: str) -> None:
    """Rename a table.  Some catalogs move its files but not what they know of its partitions."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {new_name}")
    if any(column.isPartition for column in spark.catalog.listColumns(new_name)):
        told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {new_name}").collect()}
        for row in spark.sql(f"SHOW PARTITIONS {new_name}").collect():
            values = [part.split("=", 1) for part in row.partition.split("/")]
            spec = ", ".join(f"`{unquote(c)}` = {'NULL' if v == NULL_PARTITION else _literal(unquote(v))}" for c, v in values)
            place = _literal(f"{told['Location']}/{row.partition}")
            spark.sql(f"ALTER TABLE {new_name} PARTITION ({spec}) SET LOCATION {place}")


def replace_partition(df: DataFrame, db: str, name: str, column: str, value: str) -> int:
    """Replace one partition of a table by `df`; the others stay as they are."""
    spark, table = df.sparkSession, f"{db}.{name}"
    others = [c for c in spark.table(table).columns if c != column]
    counted, seen = _counted(df.select(*others))
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = {_literal(value)}) "
        "SELECT * FROM {rows}",
        rows=counted,
    )
    return seen.get["rows"]


def query_data(spark: SparkSession, query: str, cache: bool = False, **names) -> DataFrame:
    """Run a SQL query; `names` fills {placeholders} with frames, columns or values.

    cache=True keeps the result for repeated use.  Errors are raised.
    """
    result = spark.sql(query, **names)
    return result.cache() if cache else result
