"""A corpus from raw documents: quality rules, near-duplicates, benchmark passages, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's docs.  Every stage takes nulls in any column, texts of any length,
repeated rows, an empty table (it gives one) and further columns of any name, which it keeps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casario.llm import decontamination, mixing, neardup, quality, sharding
from casario.llm.common import shared_folder

#: Target weights of the sources (others have weight 1), bytes of a block and of a shard.
WEIGHTS = {"src0": 4, "src1": 2, "src2": 2}
BLOCK_BYTES = 1 << 16
SHARD_BYTES = 1 << 20
#: A place in the mixed order is a task's number, and, in so many bits each, which of its files, and the row in it.
FILE_BITS, ROW_BITS = 16, 26


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are too short or repeat themselves go; null and empty texts are too short."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays: of repeated rows one,
    of rows without an id the first, if the group has no other.  Texts without words all stay."""
    return neardup.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; null and empty texts have none."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order in which every source is within a block of its weight; null and
    empty source are one source."""
    return mixing.mixed(docs, WEIGHTS, BLOCK_BYTES)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard each goes to and their place in the mixed order (`mixed_at`);
    a shard's rows are together and in that order.

    The tasks of the stage before are ordered by slot, so are the files of a task (it begins another
    after `spark.sql.files.maxRecordsPerFile` rows) and the rows of a file.  A null text has no bytes.
    """
    number = lambda pattern: F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).cast("long")
    file, row = number(r"-c(\d+)[^-]*$"), F.col("_metadata.row_index")
    place = F.shiftleft(F.shiftleft(number(r"^part-(\d+)"), FILE_BITS) + file, ROW_BITS) + row
    fits = (file < 1 << FILE_BITS) & (row < 1 << ROW_BITS)
    placed = docs.withColumn("mixed_at", F.when(fits, place).otherwise(F.raise_error(F.lit("too many rows or files for mixed_at"))))
    return sharding.sharded(placed, SHARD_BYTES).repartition("shard").sortWithinPartitions("shard", "mixed_at")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: The verdict of the quality rules has no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
