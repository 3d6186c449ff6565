"""Near-duplicates by bottom-k sketches, verified on full shingle sets.

A document's set holds the 64-bit hashes of its distinct 5-word shingles; its sketch is the
K smallest of them, all from one hash function.  Documents with equal sets form a class with
one representative.  Then:

1. Inverted lists of the retained values.  A pair with Jaccard similarity 0.75 or more shares
   at least `NEED` of its K retained values (K - NEED / K lies more than six standard deviations
   from what is expected; where the union fits a sketch, the bound is exact).  So a document
   only enters the lists of its K - NEED + 1 rarest values, and one that shares fewer than NEED
   values with anything is done.
2. The documents left are few; their full sets are made, and each enters the lists of its
   rarest shingles, as many as one partner at 0.75 cannot avoid, with the position they have
   in that order.
3. Each list is first compared with one hub, its least individual document.  A pair is
   estimated on its union sketch, then verified on the full sets.  The links give components.
4. Lists with several components left are joined with themselves: pairs of different
   components whose positions still allow 0.75 are estimated and verified in the same way.

So members of a large group of copies are compared with hubs, not with each other, and
documents that only share a frequent passage are told apart by position, without comparing.

A document without words, or with a null text, has an empty set and is linked with nothing.
Rows with a null id are linked, but never name a component; where all ids of a component are null,
its id is null.  Rows that repeat an id are documents of their own, each with its own set; ties
in size or frequency are settled by the row.  Texts are taken whole, however long.  An empty table
gives no rows.  Only `doc_id` and `text` are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.llm.common import dealt_join, packed, space_words, struct_udf, unpacked, written

WORDS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
K = 64
NEED = 24
#: A pair goes to the exact check from this estimate on; at 0.75 it is below with the same
#: probability as a pair shares fewer than NEED retained values (5e-11).
LEAST_ESTIMATE = NEED / K

SKETCH = "n_shingles long, print binary, sketch array<long>"

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64
)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes: dict[bytes, int] = {}
    for text in texts:
        words = space_words(text)
        if len(hashes) > 1_000_000:
            hashes.clear()
        for w in set(words):
            if w not in hashes:
                hashes[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        n = len(words)
        if n >= WORDS:
            mixed = sum(h[k : n - WORDS + 1 + k] * _FACTORS[k] for k in range(WORDS))
        else:
            mixed = (h * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n) if n else h
        yield np.unique(_scrambled(mixed)).view(np.int64) if n else h.view(np.int64)


def _sketches(texts: list[bytes | None]) -> Iterator[tuple]:
    for values in shingle_sets(texts):
        if len(values):
            yield len(values), xxhash.xxh3_128_digest(values.tobytes()), values[:K]
        else:
            yield 0, None, values


def _full_sets(texts: list[bytes | None]) -> Iterator[tuple]:
    for values in shingle_sets(texts):
        yield xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None, values


def _prints(texts: list[bytes | None]) -> Iterator[tuple]:
    for print_, _ in _full_sets(texts):
        yield (print_,)


def needed(n: Column) -> Column:
    """Retained values that a document of n shingles shares with any partner."""
    return F.when(n * 100 <= K * PERCENT, F.ceil(n * PERCENT / 100)).otherwise(F.lit(NEED))


def rare_lists(postings: DataFrame, size: Column, need: Column) -> DataFrame:
    """(value, doc, n, own, at): the rarest values of each document that it cannot avoid to
    share with a partner, `at` being their position from the rarest on; `own` counts values of
    no other document.

    `postings` has (value, doc, n); `size` is how many values a document has there, and a
    document that shares fewer than `need` is left out.
    """
    shared = postings.groupBy("value").agg(F.count("*").alias("df")).filter(F.col("df") > 1)
    lists = postings.join(shared, "value").groupBy("doc", "n").agg(F.collect_list(F.struct("df", "value")).alias("found"))
    lists = lists.filter(F.size("found") >= need).withColumn("own", size - F.size("found"))
    rarest = F.slice(F.array_sort("found"), F.lit(1), F.greatest(F.lit(0), size - need + 1 - F.col("own")).cast("int"))
    return lists.select("doc", "n", "own", F.posexplode(rarest).alias("k", "x")).select(
        F.col("x.value").alias("value"), "doc", "n", "own", (F.col("own") + F.col("k")).alias("at")
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs that are links: union-sketch estimate first, then the full sets."""
    left, right = (sets.select(F.col("doc").alias(x), F.col("values").alias(f"set_{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    low_a, low_b = F.slice("set_a", 1, K), F.slice("set_b", 1, K)
    union = F.slice(F.array_sort(F.array_union(low_a, low_b)), 1, K)
    estimate = F.size(F.array_intersect(union, F.array_intersect(low_a, low_b))) / F.size(union)
    common = F.size(F.array_intersect("set_a", "set_b"))
    exact = 100 * common >= PERCENT * (F.size("set_a") + F.size("set_b") - common)
    # Nested, so that the full sets are only intersected where the estimate lets a pair through.
    return both.filter(F.when(estimate >= LEAST_ESTIMATE, exact).otherwise(False)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(doc, component) of the documents with an edge: the smallest id reachable."""
    pairs = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(pairs.groupBy(F.col("a").alias("doc")).agg(F.least(F.col("doc"), F.min("b")).alias("component")))
    while True:
        seen = labels.select(F.col("doc").alias("b"), F.col("component").alias("near"))
        least = pairs.join(seen, "b").groupBy(F.col("a").alias("doc")).agg(F.min("near").alias("near"))
        jump = labels.select(F.col("doc").alias("component"), F.col("component").alias("far"))
        following = labels.join(least, "doc").join(jump, "component").select(
            "doc", F.least("near", "far").alias("component"), (F.least("near", "far") < F.col("component")).alias("moved")
        )
        following = written(following)
        labels = following.select("doc", "component")
        if following.filter("moved").isEmpty():
            return labels


def links(sketched: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, component) of the representatives that are linked to another one.

    `sketched` has (doc, n, sketch), a row per representative, whose number `doc` is; `classes` has
    (doc, of_print, least_id) of them, with an id of that print; `docs` has (doc_id, text).
    """
    postings = sketched.select(F.explode("sketch").alias("value"), "doc", "n")
    retained = F.least(F.col("n"), F.lit(K))
    coarse = rare_lists(postings, retained, needed(F.col("n")))
    met = coarse.groupBy("value").agg(F.count("*").alias("m")).filter("m > 1").select("value")
    left = coarse.join(met, "value", "left_semi").select("doc").distinct()
    left = written(classes.join(left, "doc", "left_semi"))

    # An id may have several texts; the print tells which of them is the representative's.
    ids = left.select(F.col("least_id").alias("id")).distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]), "left_semi").select(F.col("text").cast("binary").alias("text"))
    made = texts.select(struct_udf(_full_sets, "print binary, values array<long>")("text").alias("s")).select("s.*")
    # Null-safe, as a test for null would bring the function below the join before, to all rows.
    sets = made.join(left, made["print"].eqNullSafe(left["of_print"])).select("doc", "values")
    sets = written(sets.dropDuplicates(["doc"]))
    full = sets.select(F.explode("values").alias("value"), "doc", F.size("values").cast("long").alias("n"))
    lists = written(rare_lists(full, F.col("n"), F.ceil(F.col("n") * PERCENT / 100)))

    hubs = lists.groupBy("value").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "doc", "n")).alias("hub"))
    star = lists.join(hubs, "value").filter(
        (F.col("doc") != F.col("hub.doc"))
        & (F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * PERCENT)
    )
    star = star.select(F.least("doc", "hub.doc").alias("a"), F.greatest("doc", "hub.doc").alias("b")).distinct()
    first = written(verified(star, sets))
    labels = components(first)

    held = lists.join(labels, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    open_lists = held.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    held = written(held.join(open_lists.select("value"), "value", "left_semi"))
    a, b = (held.select("value", *(F.col(c).alias(f"{c}_{x}") for c in ("doc", "n", "at", "component"))) for x in "ab")
    # From its first common value on, each side must have what a similarity of 0.75 takes of both.
    reach = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = reach * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT
    crossing = a.join(b, "value").filter((F.col("component_a") < F.col("component_b")) & enough)
    crossing = crossing.select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b")).distinct()
    second = written(verified(crossing, sets))
    if second.isEmpty():
        return labels
    return components(first.unionByName(second))


def grouped(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_shingles, print, component_id, first) of every row: the smallest id of its
    component, and the row that has it (where all ids are null: the first row)."""
    rows = docs.select("doc_id", "text")
    sketch = struct_udf(_sketches, SKETCH)(F.col("text").cast("binary"))
    made = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", sketch.alias("s"))
    made = written(made.select("row", "doc_id", "s.*"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("least")
    # Equal prints have equal sketches, so any of them is the representative's.
    sizes = [F.first(c).alias(c) for c in ("n_shingles", "sketch")]
    by_print = made.filter("n_shingles > 0").groupBy("print")
    both = written(by_print.agg(least, F.min("row").alias("doc"), F.count("*").alias("n"), *sizes))
    classes = both.drop("n_shingles", "sketch")
    of_class = classes.select(F.col("print").alias("of_print"), "doc", F.col("least.doc_id").alias("least_id"))
    sketched = both.select("doc", F.col("n_shingles").alias("n"), "sketch")
    linked = written(classes.join(links(sketched, of_class, rows), "doc", "left").select("print", "n", "least", F.coalesce("component", "doc").alias("component")))
    best = written(linked.groupBy("component").agg(F.min("least").alias("best"), F.count("*").alias("classes")))
    named = dealt_join(linked, best, ["component"], "classes", F.xxhash64("print"))
    named = written(named.select("print", "n", F.col("best.doc_id").alias("component_id"), F.col("best.row").alias("first")))
    rows = made.select("row", "doc_id", "n_shingles", "print")
    with_words = dealt_join(rows.filter("n_shingles > 0"), named, ["print"], "n", F.col("row"))
    without = rows.filter("n_shingles = 0").select("*", F.col("doc_id").alias("component_id"), F.col("row").alias("first"))
    return with_words.unionByName(without)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: size of its set, component, and whether it is the one to keep."""
    kept = F.when(F.col("doc_id").isNull(), F.col("row") == F.col("first")).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return grouped(docs).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest id, and of repeated rows one; documents
    without words all stay."""
    verdict = grouped(docs).withColumn("stays", F.col("row") == F.col("first"))
    ids = verdict.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("stays").alias("stays"))
    single = (F.col("n") == 1) & F.col("doc_id").isNotNull()
    ids = written(ids.filter("stays").select(F.col("doc_id").alias("id"), single.alias("single")))
    out = docs.join(ids.filter("single"), docs["doc_id"] == ids["id"], "left_semi")
    several = ids.filter("not single").select("id")
    if several.isEmpty():
        return out
    # Rows that share an id are told apart by their prints.
    mine = docs.join(several, docs["doc_id"].eqNullSafe(several["id"]), "left_semi")
    texts = written(packed(mine, in_id=F.col("doc_id"), print=struct_udf(_prints, "print binary")(F.col("text").cast("binary"))["print"]))
    chosen = verdict.filter("stays and print is not null").select(F.col("doc_id").alias("id"), F.col("print").alias("of_print"))
    wanted = texts.join(chosen, F.col("in_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("of_print")), "left_semi")
    again = wanted.dropDuplicates(["in_id", "print"]).unionByName(texts.filter("print is null"))
    return out.unionByName(unpacked(again, docs))
