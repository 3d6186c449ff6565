"""Mixing sources to target weights by Pfair scheduling.

Each source is a task whose share of the output is its weight over the sum of weights.  Its
text, in a fixed pseudo-random order of documents, is cut into blocks of `block_bytes`.
Block n of a task with share a/W is released at floor(n W / a) and due at ceil((n + 1) W / a);
in every slot the released block with the earliest deadline goes next.  So each source is
less than one block ahead of or behind its share, at every slot.

Sources of equal weight form one task and take turns inside it, which keeps the bound and
keeps the number of tasks at the number of distinct weights, whatever the number of sources.
The schedule repeats after W slots (weights over their greatest common divisor); one period is
made by a fold over its slots, and every block's slot follows from it by arithmetic.  Shares are
exact at every sum of weights; the fold's time grows with W, in one task.

A source that runs out leaves its slots empty; the others keep their proportions.  No row is
dropped.  Null and empty source are one source; a null text has no bytes; rows of the same
source and id stay together in one block.  A document longer than a block uses up the next
blocks of its source too.  Documents with equal digests follow their ids; an empty table has no
slots; extra columns of any name are kept.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casario.llm.common import packed, unpacked

#: Slots that the fold gathers together; bounds copying, not results.
CHUNK_SLOTS = 1024
#: Steps of Euclid's algorithm that any two 64-bit numbers need at most.
EUCLID_STEPS = 92
#: Hex digits of the id's digest that part a source for its running sums.
SALT_DIGITS = 3


def weight_of(source: Column, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(source == name, weight).otherwise(out)
    return out


def bound(value: Column, body) -> Column:
    """`body` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def common_divisor(numbers: Column) -> Column:
    """The greatest common divisor of an array of longs."""

    def both(a: Column, b: Column) -> Column:
        start = F.struct(a.alias("a"), b.alias("b"))
        step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % s["b"]).alias("b")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(EUCLID_STEPS)), start, step)["a"]

    return F.aggregate(numbers, F.lit(0).cast("long"), both)


def schedule(tasks: DataFrame) -> DataFrame:
    """One period of the earliest-deadline-first schedule: (weight, turn, at, parts, period).

    `tasks` has a row per task: (weight, parts), shares being parts over their sum; the parts
    returned are in lowest terms.  `at` is the slot of the task's block `turn`.
    """
    task = F.struct("weight", F.col("parts").cast("long").alias("parts"))
    listed = tasks.agg(F.array_sort(F.collect_list(task)).alias("tasks")).filter(F.size("tasks") > 0)
    listed = listed.withColumn("divisor", common_divisor(F.col("tasks.parts")))
    lowest = F.transform("tasks", lambda t: F.struct(t["weight"].alias("weight"), F.floor(t["parts"] / F.col("divisor")).alias("parts")))
    listed = listed.select(lowest.alias("tasks"))
    listed = listed.withColumn("period", F.aggregate("tasks", F.lit(0).cast("long"), lambda sum_, t: sum_ + t["parts"]))

    def next_slot(state: Column, slot: Column) -> Column:
        def bid(task: Column, k: Column) -> Column:
            n = F.element_at(state["done"], k + 1)
            release = F.floor(n * F.col("period") / task["parts"])
            deadline = F.ceil((n + 1) * F.col("period") / task["parts"])
            return F.when(release <= slot, F.struct(deadline.alias("deadline"), k.alias("task")))

        def picked(chosen: Column) -> Column:
            done = F.transform(state["done"], lambda n, k: F.when(k == chosen, n + 1).otherwise(n))
            return F.struct(done.alias("done"), F.concat(state["picks"], F.array(chosen)).alias("picks"))

        return bound(F.array_min(F.array_compact(F.transform("tasks", bid)))["task"], picked)

    def next_chunk(state: Column, chunk: Column) -> Column:
        first = chunk * CHUNK_SLOTS
        start = F.struct(state["done"].alias("done"), F.array().cast("array<int>").alias("picks"))
        last = F.least(first + CHUNK_SLOTS, F.col("period")) - 1
        return bound(
            F.aggregate(F.sequence(first, last), start, next_slot),
            lambda s: F.struct(s["done"].alias("done"), F.concat(state["chunks"], F.array(s["picks"])).alias("chunks")),
        )

    start = F.struct(
        F.transform("tasks", lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast("array<array<int>>").alias("chunks")
    )
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("period") - 1) / CHUNK_SLOTS))
    picks = F.flatten(F.aggregate(chunks, start, next_chunk)["chunks"])
    slots = listed.select("tasks", "period", F.posexplode(picks).alias("at", "pick"))
    turn = F.row_number().over(Window.partitionBy("pick").orderBy("at")) - 1
    task = F.element_at("tasks", F.col("pick") + 1)
    return slots.select(
        task["weight"].alias("weight"), turn.cast("long").alias("turn"), F.col("at").cast("long").alias("at"),
        task["parts"].alias("parts"), "period",
    )


def slots(docs: DataFrame, weights: dict[str, int], block_bytes: int, default: int = 1) -> DataFrame:
    """A row per source and document id: bytes, place in the source, block, slot, release, deadline.

    Narrow rows only; texts are read for their length and not shuffled.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = (
        docs.select(F.coalesce("source", F.lit("")).alias("source"), "doc_id", size.alias("n_bytes"))
        .groupBy("source", "doc_id")
        .agg(F.sum("n_bytes").alias("n_bytes"))
        .withColumn("digest", digest)
        .withColumn("salt", F.substring("digest", 1, SALT_DIGITS))
    )
    parts = rows.groupBy("source", "salt").agg(F.sum("n_bytes").alias("part_bytes"))
    ahead = F.sum("part_bytes").over(Window.partitionBy("source").orderBy("salt")) - F.col("part_bytes")
    parts = parts.select("source", "salt", ahead.alias("ahead"))
    # Every source is in `parts`, so its sources are those of the documents.
    sources = parts.select("source").distinct().withColumn("weight", weight_of(F.col("source"), weights, default))
    turn = (F.row_number().over(Window.partitionBy("weight").orderBy("source")) - 1).cast("long")
    members = sources.withColumn("member", turn)
    tasks = sources.groupBy("weight").agg(F.count("*").alias("n_members"))
    share = F.col("weight") * F.col("n_members")
    period = schedule(tasks.select("weight", share.alias("parts")))
    before = F.sum("n_bytes").over(Window.partitionBy("source", "salt").orderBy("digest", "doc_id")) - F.col("n_bytes")
    placed = (
        rows.withColumn("before", before)
        .join(parts, ["source", "salt"])
        .withColumn("start", F.col("before") + F.col("ahead"))
        .withColumn("block", F.floor(F.col("start") / block_bytes))
        .join(members.join(tasks, "weight"), "source")
        .withColumn("n", F.col("block") * F.col("n_members") + F.col("member"))
    )
    # A row per distinct weight is broadcast; the period has a row per slot, and Spark sizes it up.
    per_task = F.broadcast(period.select("weight", "parts", "period").distinct())
    placed = placed.join(per_task, "weight").withColumn("turn", F.col("n") % F.col("parts"))
    placed = placed.join(period.select("weight", "turn", "at"), ["weight", "turn"])
    rounds = F.floor(F.col("n") / F.col("parts"))
    return placed.select(
        "source", "doc_id", "n_bytes", "start", "block",
        (rounds * F.col("period") + F.col("at")).alias("slot"),
        F.floor(F.col("n") * F.col("period") / F.col("parts")).alias("release"),
        F.ceil((F.col("n") + 1) * F.col("period") / F.col("parts")).alias("deadline"),
    )


def mixed(docs: DataFrame, weights: dict[str, int], block_bytes: int, default: int = 1) -> DataFrame:
    """All documents with their columns, in mixed order: written out, the files follow the slots."""
    order = slots(docs, weights, block_bytes, default).select(
        F.col("source").alias("in_source"), F.col("doc_id").alias("id"), "slot", "start"
    )
    keyed = packed(docs, of_source=F.coalesce("source", F.lit("")), of_id=F.col("doc_id"))
    # Hashing the narrow side leaves the texts unsorted.
    same = (F.col("of_source") == F.col("in_source")) & F.col("of_id").eqNullSafe(F.col("id"))
    joined = keyed.join(order.hint("shuffle_hash"), same)
    return unpacked(joined.repartitionByRange("slot").sortWithinPartitions("slot", "start"), docs)
