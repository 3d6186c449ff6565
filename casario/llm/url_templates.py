"""URL filter: rules, and a tree of path templates per host for what no rule decides.

Paths are cut into segments.  Level by level, down to the last segment of the longest path, a
node of the tree (a host and the template so far) sees its children.  Numbers and long
hexadecimal strings are wildcards.  Of the others a child whose labelled share differs
significantly from its node's (by the z of its smoothed share, above `SIMILAR`) stays as it is;
one that is rare (at most `RARE` of the node's pages) in a node of `MANY` children or more becomes
a wildcard; one with labels that is similar is merged with its like into one branch.  A child is
judged by its own share, so one more sibling changes nothing for it.

Labels are the verdicts of the rules.  A template's share of allowed pages is smoothed
towards the same template on all hosts, and that towards the whole table; a template whose
smoothed share is below `PURITY` is blocked.

Keys that hold more than a thousandth of the rows of a join (there are at most a thousand such) are
salted, so that a large host, a common template or a much repeated url is not one task's.

A null url, or one without `://`, has an empty host and path.  Urls of any length and depth are
taken whole; equal urls get equal verdicts, also under repeated ids, and null ids are kept.  An
empty table gives an empty result.  Only the id and the url are read, so other columns may have any
name.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.llm.common import dealt_join, written

# The rules (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: In a node with at least MANY different children, those with at most RARE of its pages become a wildcard.
MANY = 12
RARE = 0.05
#: z value up to which the labelled shares of a branch and its node count as similar.
SIMILAR = 1.96
#: Weight of the prior in labelled pages, and the least smoothed share that is allowed.
PRIOR = 4.0
PURITY = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for decision, site, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(prefix)
        rule = F.when(fits, site + prefix).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def general(segment: Column) -> Column:
    """A segment as the tree sees it."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return F.when(stem.rlike("^[0-9]+$") | stem.rlike("^[0-9A-Fa-f-]{16,}$"), "*").otherwise(segment)


def kept_child() -> Column:
    """What a child becomes, from its own counts and its node's (`all_`)."""
    pooled = F.col("all_allowed") / F.col("all_labelled")
    gap = smoothed(F.col("allowed"), F.col("labelled"), pooled) - pooled
    spread = pooled * (1 - pooled) / (F.col("labelled") + PRIOR)
    different = (F.col("labelled") > 0) & (gap * gap > SIMILAR * SIMILAR * spread)
    rare = (F.col("branches") >= MANY) & (F.col("n") <= RARE * F.col("all_n"))
    return (
        F.when(F.col("child") == "*", "*").when(different, F.col("child")).when(rare, "*")
        .when((F.col("labelled") > 0) & (F.col("branches") > 1), "~").otherwise(F.col("child"))
    )


def templates(pages: DataFrame) -> DataFrame:
    """Pages counted by path, with the template each path falls under.

    `pages` has (host, path, label), label 1, 0 or null.  Returns (host, path, n, labelled,
    allowed, template)."""
    paths = pages.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("allowed")
    )
    parts = F.split("path", "/")
    level = written(paths.select("*", F.lit("").alias("template"), F.slice(parts, F.lit(2), F.size(parts)).alias("rest")))
    counts = [F.sum(c).alias(c) for c in ("n", "labelled", "allowed")]
    done = []
    while True:
        done.append(level.filter(F.size("rest") == 0).drop("rest"))
        open_ = level.filter(F.size("rest") > 0).withColumn("child", general(F.get("rest", F.lit(0))))
        children = written(open_.groupBy("host", "template", "child").agg(*counts, F.count("*").alias("paths")))
        if children.isEmpty():
            break
        nodes = children.groupBy("host", "template").agg(
            F.count("*").alias("branches"), F.sum("paths").alias("all_paths"), F.sum("n").alias("all_n"),
            F.sum("labelled").alias("all_labelled"), F.sum("allowed").alias("all_allowed"),
        )
        nodes = written(nodes.withColumn("children", F.col("branches")))
        named = dealt_join(children, nodes, ["host", "template"], "children", F.xxhash64("child"))
        named = written(named.select("host", "template", "child", "paths", kept_child().alias("kept"), (F.col("all_paths") == 1).alias("single")))
        # Where a node has one path, nothing is compared any more: the rest follows at once.
        tail = F.array_join(F.transform("rest", general), "/")
        found = dealt_join(open_, named, ["host", "template", "child"], "paths", F.xxhash64("path"))
        level = written(found.select(
            "host", "path", "n", "labelled", "allowed",
            F.concat_ws("/", "template", F.when(F.col("single"), tail).otherwise(F.col("kept"))).alias("template"),
            F.when(F.col("single"), F.slice("rest", 1, 0)).otherwise(F.slice("rest", F.lit(2), F.size("rest"))).alias("rest"),
        ))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def smoothed(allowed: Column, labelled: Column, prior: Column) -> Column:
    return (allowed + PRIOR * prior) / (labelled + PRIOR)


def judged(pages: DataFrame, rules=RULES, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """A row per page: host, path, rule, verdict, and the template with its purity."""
    found = pages.select(F.col(page_id), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    found = found.withColumns({"rule": rule, "ruled": verdict})
    labelled = found.withColumn("label", F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", 0))
    paths = written(templates(labelled.select("host", "path", "label")))
    sums = [F.sum(c).alias(c) for c in ("labelled", "allowed")]
    per_host = written(paths.groupBy("host", "template").agg(*sums, F.count("*").alias("paths")))
    total = per_host.agg(F.struct(F.coalesce(F.sum("allowed"), F.lit(0)).alias("a"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("n"))).scalar()
    everywhere = per_host.groupBy("template").agg(
        F.sum("labelled").alias("every_labelled"), F.sum("allowed").alias("every_allowed"), F.count("*").alias("hosts")
    )
    prior = smoothed(F.col("every_allowed"), F.col("every_labelled"), smoothed(total["a"], total["n"], F.lit(0.5)))
    purity = dealt_join(per_host, written(everywhere), ["template"], "hosts", F.xxhash64("host")).select(
        "host", "template", "paths", smoothed(F.col("allowed"), F.col("labelled"), prior).alias("purity")
    )
    decided = dealt_join(paths.select("host", "path", "template", "n"), written(purity), ["host", "template"], "paths", F.xxhash64("path"))
    method = F.when(F.col("purity") >= PURITY, "allow").otherwise("block")
    return dealt_join(found, written(decided), ["host", "path"], "n", F.monotonically_increasing_id()).select(
        page_id, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity"
    )
