"""JSON feeds of listing records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casario.functions import origin_of
from casario.functions.text import ORIGINS, UNKNOWN_ORIGIN
from casario.schema import FEED, RAW

PRICES = ("preco", "condo")


def read_listings(
    spark: SparkSession,
    path: str,
    date_ref: str,
    mapping: Mapping[str, str] = ORIGINS,
    default: str = UNKNOWN_ORIGIN,
    layout: str = "lines",
) -> DataFrame:
    """All *.json files directly in a folder, tagged with their portal and month.

    Columns are matched by name and kept as text.  A malformed file fails the read.

    layout="lines" reads one record per line, with or without the brackets and commas of an
    array around them, as feed exporters write them; such files are split among tasks.
    layout="array" takes an array or an object laid out in any way.  Its lines are split among tasks
    too, and put together to records by two shuffles; only what is one line stays in one task.
    """
    if layout == "lines":
        text = spark.read.option("pathGlobFilter", "*.json").text(path)
        feed = parse_lines(text.select("value", "_metadata"))
    elif layout == "array":
        lines = spark.read.option("pathGlobFilter", "*.json").text(path)
        feed = parse_arrays(lines.select("value", "_metadata"))
    else:
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    tagged = feed.withColumn(
        "origem", origin_of(F.col("_metadata.file_name"), mapping, default)
    ).withColumn("date_ref", F.lit(date_ref))
    return tagged.select(*RAW.fieldNames())


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Feed records out of JSON text, one record per row; other columns are carried along.

    Brackets and commas around a record are dropped, and so are rows with nothing else.
    """
    opened = F.regexp_replace(value, r"^\s*\[?\s*", "")
    bare = F.regexp_replace(opened, r"[,\]\s]*$", "")
    others = [name for name in lines.columns if name != value]
    records = lines.where(bare != "").select(F.parse_json(bare).alias("record"), *others)
    return records.select(*_fields(F.col("record")), *others)


def parse_arrays(lines: DataFrame) -> DataFrame:
    """Feed records out of the lines (`value`, `_metadata`) of files that hold one JSON array or object.

    No JSON string runs over the end of a line, so a line tells by itself how many brackets it opens
    and closes.  Summed by block of a file, then inside the blocks, that gives the depth at each
    line's end; where it is that of the array, the lines so far hold whole records.  A line alone
    before or after all records is a bracket.
    """
    place = F.monotonically_increasing_id()
    bare = F.regexp_replace("value", r'"(?:[^"\\]|\\.)*+"', "")
    depth = F.regexp_count(bare, F.lit(r"[\[{]")) - F.regexp_count(bare, F.lit(r"[\]}]"))
    rows = lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"), place.alias("line"), depth.alias("change"),
    ).where(F.trim("value") != "")
    # A row per block of each file: the depth at its start, and whether the file is an array.
    first = F.min_by(F.ltrim("value"), "line")
    blocks = rows.groupBy("file", "block").agg(F.sum("change").alias("change"), first.alias("first"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    array = F.first("first").over(in_file).startswith("[")
    blocks = blocks.select("file", "block", (F.sum("change").over(in_file) - F.col("change")).alias("before"), array.cast("int").alias("base"))
    in_block = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(blocks, ["file", "block"]).withColumn("depth", F.col("before") + F.sum("change").over(in_block))
    # Lines up to one that ends between records belong together; the number of such ends counts on from block to block.
    ends = (F.col("depth") <= F.col("base")).cast("int")
    rows = rows.withColumn("ends", F.sum(ends).over(in_block) - ends).withColumn("is_end", ends)
    done = rows.groupBy("file", "block").agg(F.sum("is_end").alias("ends_here"))
    done = done.select("file", "block", (F.sum("ends_here").over(in_file) - F.col("ends_here")).alias("ends_before"))
    rows = rows.join(done, ["file", "block"]).withColumn("part", F.col("ends") + F.col("ends_before"))
    parts = rows.groupBy("file", "file_name", "part").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"), F.max("base").alias("base"))
    text = F.array_join("lines.value", "\n")
    inside = F.regexp_replace(F.regexp_replace(text, r"^[\s\[,]+", ""), r"(?<=\})[\s,]*\]?\s*$|^[\s,\]]+$|[\s,]+$", "")
    whole = parts.select("file_name", F.when(F.col("base") == 1, F.concat(F.lit("["), inside, F.lit("]"))).otherwise(F.concat(F.lit("["), text, F.lit("]"))).alias("text"))
    each = whole.select(F.explode(F.from_json("text", "array<variant>", {"mode": "FAILFAST"})).alias("record"), F.struct("file_name").alias("_metadata"))
    return each.select(*_fields(F.col("record")), "_metadata")


def _fields(record: Column) -> list[Column]:
    """The feed's fields as text.  A JSON number among the prices loses its fraction: the point
    of a price text groups thousands."""
    fields = []
    for name in FEED.fieldNames():
        text = F.try_variant_get(record, f"$.{name}", "string")
        if name in PRICES:
            number = F.schema_of_variant(F.try_variant_get(record, f"$.{name}", "variant")).rlike("^(BIGINT|DECIMAL|DOUBLE)")
            amount = F.try_variant_get(record, f"$.{name}", "double")
            whole = F.signum(amount) * F.floor(F.abs(amount) + F.lit(0.5))
            text = F.when(number, whole.cast("decimal(38,0)").cast("string")).otherwise(text)
        fields.append(text.alias(name))
    return fields


def write_feed(records: DataFrame, path: str) -> None:
    """Write records as UTF-8 JSON, one per line, NULL fields included."""
    records.write.mode("errorifexists").option("ignoreNullFields", False).option(
        "encoding", "UTF-8"
    ).json(path)


def folder_table(path: str) -> str:
    """Table name of a feed folder: its base name up to the first dash."""
    return path.rsplit("/", 1)[-1].split("-", 1)[0]


def folder_table_of(path: Column) -> Column:
    """The same for a column of paths."""
    return F.substring_index(F.substring_index(path, "/", -1), "-", 1)
