"""Merkle manifest of a dataset: a hash tree per language, a tree of their roots, and a proof
for every document, made by pointer jumping.

A leaf is the digest of a row's fields.  Leaves of a language are in order of their id; every
`FAN` consecutive nodes, the last run perhaps fewer, are hashed to a node above, until one is
left.  The language roots, in order of the language, are the leaves of a last tree.

Order: rows are dealt out by range and written, so each file is a piece of the order.  Counts
per file and language place every row by arithmetic; no language is ever in one task.

Proofs: every run but the root points at the run above it and holds the digests beside its own
there, a segment of a proof.  A self-join follows the pointers: a run takes over the pointer
of the run it points at and appends that one's segments, so the distance doubles with every
round until all runs point at the root.  The leaves of a run share all of its segments, so they
are unfolded last and travel in narrow rows.  Only runs high enough to be pointed at take part
as targets; where they are few, Spark's size check broadcasts them, and where they are many, so
are the keys.

Null fields are hashed as a mark of their own.  The null language is one language, the first; a
null id comes before all others.  Rows with equal id and language are in order of their
leaves, so repeated rows are all leaves, each with a proof.  A run of one is hashed too; a lone
leaf or language root is its own root.  Texts are hashed whole, however long.  An empty table
gives no rows.  Only the columns named here are read, so others may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casario.llm.common import written

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the language roots; the others are numbered from 0.
TOP = -1


def field(value: Column) -> Column:
    """A field as the leaf hashes it: bytes, colon, value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    """Digest of a row's fields (binary), some of them replaced."""
    return F.unhex(F.sha2(F.concat(*(field(changed.get(name, F.col(name))) for name in FIELDS)), 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_hash(digests: Column) -> Column:
    """Digest (binary) of an array of digests, as hex text put together."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, hexed), ""), 256))


def beside(digests: Column, pos: Column, top: Column) -> Column:
    """A segment: the digests before and after place `pos` of a run, and whether it is in the last tree."""
    hexes = F.transform(digests, F.hex)
    rest = lambda part: F.unhex(F.array_join(part, ""))
    before, after = F.slice(hexes, F.lit(1), pos), F.slice(hexes, pos + 2, F.size(hexes))
    return F.struct(rest(before).alias("before"), rest(after).alias("after"), top.alias("top"))


def no_path() -> Column:
    return F.array().cast("array<struct<before: binary, after: binary, top: boolean>>")


def folded(leaf: Column, proof: Column) -> Column:
    """The root (hex) that follows from a leaf (hex) and a proof (segments of hex digests)."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def in_order(frame: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written in order, with `file` and `row`; and (file, before), the rows in files before.

    Equal rows may be dealt to several files; a file that begins with them and goes on comes last.
    """
    dealt = frame.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie")
    rows = written(dealt.sortWithinPartitions(*order, "_tie").drop("_tie"))
    rows = rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    key = F.struct(*order)
    files = rows.groupBy("file").agg(F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
    upto = F.sum("n").over(Window.orderBy("first", "last", "file"))
    return rows, files.select("file", (upto - F.col("n")).alias("before"))


def placed(leaves: DataFrame) -> DataFrame:
    """Leaves with `tree` (their language's number), `at` (place in it) and `size` (leaves of it)."""
    rows, files = in_order(leaves, "lang", "doc_id", "leaf")
    parts = rows.groupBy("file", "lang").agg(F.min("row").alias("row"), F.count("*").alias("n")).join(files, "file")
    parts = written(parts.withColumn("start", F.col("before") + F.col("row")))
    langs, lang_files = in_order(parts.groupBy("lang").agg(F.min("start").alias("first"), F.sum("n").alias("size")), "lang")
    langs = langs.join(lang_files, "file").select(F.col("lang").alias("of"), "first", "size", (F.col("before") + F.col("row")).alias("tree"))
    parts = parts.join(langs, F.col("lang").eqNullSafe(F.col("of"))).select(
        F.col("file").alias("in_file"), F.col("lang").alias("in_lang"), "tree", "size", (F.col("before") - F.col("first")).alias("shift")
    )
    here = (F.col("file") == F.col("in_file")) & F.col("lang").eqNullSafe(F.col("in_lang"))
    return rows.join(parts, here).withColumn("at", F.col("row") + F.col("shift")).drop("file", "row", "in_file", "in_lang", "shift")


def _id(tree: Column, level: Column, at: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), at.cast("long").alias("at"))


def _up(at: Column | str) -> Column:
    return F.floor(F.col(at) / FAN) if isinstance(at, str) else F.floor(at / FAN)


def levels_above(size: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // FAN), n + 1
    return n


def climb(nodes: DataFrame, level: int, height: int) -> list[DataFrame]:
    """The levels above `nodes` (id, at, size, digest), written: the same columns and `kids`."""
    out = []
    for up in range(level + 1, height + 1):
        kid = F.struct((F.col("at") % FAN).cast("int").alias("pos"), "id", "digest")
        runs = nodes.filter("size > 1").groupBy(
            F.col("id.tree").alias("tree") if level else F.lit(TOP).cast("long").alias("tree"),
            _up("at").alias("at"), F.ceil(F.col("size") / FAN).alias("size"),
        ).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
        runs = runs.select(
            _id(F.col("tree"), F.lit(up), F.col("at")).alias("id"), "at", "size", joined_hash(F.col("kids.digest")).alias("digest"), "kids"
        )
        nodes = written(runs)
        level = up
        out.append(nodes)
    return out


def jumped(pointers: DataFrame, depth: int) -> DataFrame:
    """(id, up, path) of runs, followed until every `up` is the root, `depth` runs away at most."""
    reach = 1
    while reach < depth:
        far = pointers.filter((F.col("id.tree") == TOP) | (F.col("id.level") > reach))
        far = far.select(F.col("id").alias("far_id"), F.col("up").alias("far_up"), F.col("path").alias("far_path"))
        path = F.concat("path", F.coalesce("far_path", no_path()))
        followed = pointers.join(far, F.col("up") == F.col("far_id"), "left")
        pointers = written(followed.select("id", F.coalesce("far_up", "up").alias("up"), path.alias("path")))
        reach *= 2
    return pointers


def proofs(leaves: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The manifest of leaves (lang, doc_id, leaf): a row per leaf with `leaf`, `subroot`, `root` in
    hex and `proof`, the segments (before, after) in hex from its own run to the root.

    `carry` names further columns of `leaves` that come along.
    """
    leaves = written(leaves.select("lang", "doc_id", "leaf", *carry))
    nodes = placed(leaves)
    # A language with one leaf has no run; its leaf is a node of the last tree.
    lone = F.col("size") == 1
    kid = F.struct(
        F.when(lone, F.col("tree") % FAN).otherwise(F.col("at") % FAN).cast("int").alias("pos"), "doc_id", "leaf", *carry
    )
    grouped = nodes.groupBy(
        F.when(lone, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("tree"),
        F.when(lone, _up("tree")).otherwise(_up("at")).alias("at"), F.ceil(F.col("size") / FAN).alias("size"),
    ).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
    grouped = written(grouped.withColumn("id", _id(F.col("tree"), F.lit(1), F.col("at"))))
    in_langs, alone = grouped.filter(F.col("tree") != TOP), grouped.filter(F.col("tree") == TOP)

    first = written(in_langs.select("id", "at", "size", joined_hash(F.col("kids.leaf")).alias("digest")))
    largest = first.agg(F.max("size")).first()[0]
    height = 1 + levels_above(largest) if largest else 0
    above = climb(first, 1, height)
    tops = [run.filter("size = 1").select(F.col("id.tree").alias("at"), "id", "digest") for run in (first, *above)]
    each = alone.select("at", F.explode("kids").alias("kid"))
    number = F.col("at") * FAN + F.col("kid.pos")
    tops.append(each.select(number.alias("at"), _id(number, F.lit(0), F.lit(0)).alias("id"), F.col("kid.leaf").alias("digest")))
    tops = written(reduce(DataFrame.unionByName, tops))
    n_langs = tops.count()
    last = climb(tops.withColumn("size", F.lit(n_langs).cast("long")), 0, levels_above(n_langs))
    root = (last[-1] if last else tops).select(hexed(F.col("digest"))).first()
    root = F.lit(root[0] if root else None).cast("string")

    top = lambda tree: tree == TOP
    segment = beside(F.col("kids.digest"), F.col("kid.pos"), top(F.col("up.tree")))
    pointers = [
        run.select(F.col("id").alias("up"), "kids", F.explode("kids").alias("kid"))
        .filter("kid.id.level > 0")
        .select(F.col("kid.id").alias("id"), "up", F.array(segment).alias("path"))
        for run in (*above, *last)
    ]
    own = in_langs.select("id", "kids", F.col("kids.leaf").alias("digests"))
    if last:
        runs = last[0].select("id", F.col("kids.digest").alias("digests"))
        alone = alone.select("id", "kids").join(runs, "id")
    else:
        # The only language has one leaf, which is the root and has no run.
        alone = alone.select("id", "kids", F.lit(None).cast("array<binary>").alias("digests"))
    runs = own.unionByName(alone)
    if pointers:
        path = jumped(written(reduce(DataFrame.unionByName, pointers)), height + len(last) - 1)
        runs = runs.join(path.select("id", "path"), "id", "left")
    else:
        runs = runs.withColumn("path", no_path())
    in_hex = lambda s: F.named_struct(F.lit("before"), hexed(s["before"]), F.lit("after"), hexed(s["after"]))
    runs = runs.withColumn("path", F.coalesce("path", no_path()))
    below = F.transform(F.filter("path", lambda s: ~s["top"]), in_hex)
    of_run = folded(hexed(joined_hash(F.col("digests"))), below)
    runs = runs.select("id", "digests", of_run.alias("of_run"), F.transform("path", in_hex).alias("path"), F.explode("kids").alias("kid"))
    leaf = hexed(F.col("kid.leaf"))
    own = F.when(F.col("digests").isNotNull(), F.array(in_hex(beside(F.col("digests"), F.col("kid.pos"), F.lit(False)))))
    return runs.select(
        F.col("kid.doc_id").alias("doc_id"), leaf.alias("leaf"),
        F.when(top(F.col("id.tree")), leaf).otherwise(F.col("of_run")).alias("subroot"), root.alias("root"),
        F.coalesce(F.concat(own, "path"), "path").alias("proof"),
        *(F.col("kid")[name].alias(name) for name in carry),
    )


def checked(docs: DataFrame, every: int = 3) -> DataFrame:
    """The manifest, held against a copy of the table in which the rows whose crc32 of the id `every`
    divides have their text's A-Z lower-cased (a null id is left alone): doc_id, leaf, subroot,
    root, proof_sha256 of the untouched table, the root folded from the copy's leaf, and whether it fits."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    leaves = docs.select("lang", "doc_id", leaf_of().alias("leaf"), F.when(touched, leaf_of(text=lowered)).alias("copy"))
    found = proofs(leaves, carry=("copy",))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), "")
    found = found.withColumn("folded_root", folded(F.coalesce(hexed(F.col("copy")), F.col("leaf")), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
