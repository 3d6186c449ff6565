"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a document's hash.  A bucket that holds more
than the byte limit splits on its next bit; the others stay as they are, so buckets have
depths of their own.  Bucket sizes come from a hierarchy of directories of `STEP` bits each:
the first is one aggregate of at most 2**STEP rows; a further one is made only below cells
that are still too large.

Rows with the same id have the same hash and no bit can part them; where they exceed the
limit together, their bucket overflows into pages.  Columns of the input named as ours are
replaced.  A document above the limit is a shard
(or page) of its own.  A null text has no bytes; a null id is hashed as the empty string; an empty
table has no shards.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casario.llm.common import packed, unpacked, written

#: Bits of a hash, and bits of one directory level.
BITS = 60
STEP = 12


def hash_bits(doc_id: str | Column) -> Column:
    """The first 60 bits of the id's MD5 digest, as a number."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column, depth: int | Column) -> Column:
    return F.call_function("shiftrightunsigned", bits, (F.lit(BITS) - depth).cast("int"))


def directory_level(sized: DataFrame, level: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Directory of one level, and the cells whose buckets must split further.

    `sized` has (_hash, _bytes) of the rows that reach this level.  The directory maps each
    cell (hash prefix of the level's full depth) to the depth and bytes of its bucket.
    """
    low, high = STEP * level, STEP * (level + 1)
    cells = sized.groupBy(_prefix(F.col("_hash"), F.lit(high)).alias("cell")).agg(F.sum("_bytes").alias("bytes"))
    nodes = (
        cells.select("bytes", "cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
        .groupBy("depth", F.call_function("shiftrightunsigned", "cell", (F.lit(high) - F.col("depth")).cast("int")).alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"))
    )
    nodes = written(nodes)
    split = nodes.filter(F.col("bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = nodes.withColumn("parent", F.call_function("shiftrightunsigned", "prefix", F.lit(1)))
    reached = below.filter(F.col("depth") == low).unionByName(below.filter(F.col("depth") > low).join(split, ["depth", "parent"], "left_semi"))
    last = (F.col("depth") == high) & F.lit(high == BITS)
    leaves = reached.filter((F.col("bytes") <= limit) | last)
    width = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(high) - F.col("depth")).cast("int"))
    directory = leaves.select(
        F.explode(F.sequence(F.col("prefix") * width, (F.col("prefix") + 1) * width - 1)).alias(f"_cell{level}"),
        F.col("depth").alias(f"_depth{level}"),
        F.col("bytes").alias(f"_bytes{level}"),
    )
    oversized = nodes.filter((F.col("depth") == high) & (F.col("bytes") > limit) & ~last).select(F.col("prefix").alias("cell"))
    return directory, oversized


def sharded(docs: DataFrame, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `shard` (the bucket's hash prefix in binary digits, and for an overflowing
    bucket `/` and a page), `shard_depth` and `shard_bytes` (of the bucket)."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    out = packed(docs, _hash=hash_bits(doc_id), _bytes=size)
    sized = written(out.select("_hash", "_bytes"))
    rest, levels = sized, 0
    for level in range(BITS // STEP):
        directory, oversized = directory_level(rest, level, limit)
        cell = _prefix(F.col("_hash"), F.lit(STEP * (level + 1)))
        # The first level has 2**STEP rows at most; Spark sizes up the others.
        directory = F.broadcast(directory) if level == 0 else directory
        out = out.withColumn(f"_cell{level}", cell).join(directory, f"_cell{level}", "left")
        levels = level + 1
        if oversized.isEmpty():
            break
        rest = rest.withColumn("cell", cell).join(oversized, "cell", "left_semi").drop("cell")
    out = out.withColumns(
        {
            "shard_depth": F.coalesce(*(F.col(f"_depth{k}") for k in range(levels))),
            "shard_bytes": F.coalesce(*(F.col(f"_bytes{k}") for k in range(levels))),
        }
    )
    bits = F.substring(F.lpad(F.bin("_hash"), BITS, "0"), F.lit(1), F.col("shard_depth"))
    out = out.withColumn("shard", bits)
    if levels * STEP == BITS:
        out = _paged(out, limit)
    out = out.withColumn("shard_depth", F.col("shard_depth").cast("long"))
    return unpacked(out, docs, "shard", "shard_depth", "shard_bytes")


def _paged(out: DataFrame, limit: int) -> DataFrame:
    """Pages for buckets that no bit can split: rows of the same id, counted off in each input
    partition, so that no task holds them all."""
    over = F.col("shard_bytes") > limit
    rows = out.filter(over).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    before = F.sum("_bytes").over(Window.partitionBy("_hash", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    largest = F.max("_bytes").over(Window.partitionBy("_hash", "_part"))
    page = F.floor(F.coalesce(before, F.lit(0)) / F.greatest(F.lit(1), F.lit(limit) - largest))
    rows = rows.withColumn("shard", F.concat_ws("/", "shard", F.concat_ws("-", "_part", page.cast("string"))))
    return out.filter(~over).unionByName(rows.drop("_part", "_at"))


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """A row per document: its bytes and its shard."""
    sized = docs.select("doc_id", F.col("text"))
    return sharded(sized, limit).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "shard", "shard_depth", "shard_bytes"
    )
