"""Prediction by partial matching over bytes, and a unigram base over words.

The trie holds the counts of all byte contexts of up to `order` bytes that training texts
have.  A byte that a context has seen costs its count over the context's total plus its
distinct symbols; any other costs an escape (the distinct symbols over the same sum), and
then what the next shorter context says with the symbols of the longer ones excluded; the
last resort is uniform over what is left.  The model is pretrained on the training
documents and fixed; a text's score is its log10 probability with its end (byte 0).

The trie is a written table of grams (a context of `order` bytes and the byte after it) with
their counts; it grows with the corpus, and shorter contexts are sums of it.  A byte's price
depends on its gram alone, so every distinct gram is priced once: a seen one by its context, an
unseen one from the longest context down.  As the symbols of a context are among those of the
next shorter one, what is excluded there is a sum kept with the longer context.

The most frequent grams (`HOT_GRAMS` at most) and words (`HOT_WORDS`, `HOT_WORD_BYTES` together) are
sent to every executor with exact prices; all others are joined.  Which they are follows from how
many there are of each frequency, so no task sorts them.  These numbers bound memory, not results.

Training documents are those whose crc32 of the id as text is not `HELD_OUT` modulo
`FOLDS`; a null id counts as the empty string.  A null text is an empty one: just an end.  Texts
are scored whole, however long; repeated rows count each time and get equal scores; an empty
table gives no rows.  Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.llm.common import space_words, struct_udf, written

#: Bytes of the longest context unless the caller names more (six at most: a gram is one number).
ORDER = 2
FOLDS = 7
HELD_OUT = 2
HOT_WORDS = 100_000
HOT_WORD_BYTES = 8 << 20
#: A longer word is joined, however frequent.
HOT_BYTES = 4096
HOT_GRAMS = 500_000
#: Distinct words, and bytes of text, that a task gathers before it passes them on.
FLUSH = 400_000
FLUSH_BYTES = 1 << 22
#: Orders below this have tables of at most 2**16 grams, which are broadcast.
SMALL_ORDERS = 2
#: The end of a text as a word; words have no space.
END = b" "

SCHEMA = (
    "n_tokens long, hot_known long, hot_score double, score double, rare array<struct<word:binary,n:long>>, "
    "grams array<long>, times array<long>"
)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def grams_of(text: bytes, order: int) -> np.ndarray:
    """Each byte of the text and its end, below the `order` bytes before it."""
    x = np.frombuffer(b"\0" * order + text + b"\0", np.uint8)
    n = len(x) - order
    out = np.zeros(n, np.int64)
    for k in range(order + 1):
        out = out << 8 | x[k : k + n]
    return out


def gathered(docs: DataFrame, order: int) -> DataFrame:
    """(word, gram, n): counts of words (gram null) and of byte grams (word null)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        grams: list[np.ndarray] = []
        held = 0

        def rows() -> Iterator[pd.DataFrame]:
            yield pd.DataFrame({"word": list(words), "gram": None, "n": list(words.values())})
            keys, n = np.unique(np.concatenate([np.zeros(0, np.int64), *grams]), return_counts=True)
            yield pd.DataFrame({"word": None, "gram": keys, "n": n})
            words.clear()
            grams.clear()

        for batch in batches:
            for text in batch["text"]:
                text = text or b""
                words.update(space_words(text))
                words[END] += 1
                grams.append(grams_of(text, order))
                held += len(grams[-1])
                if held > FLUSH_BYTES or len(words) > FLUSH:
                    yield from rows()
                    held = 0
        yield from rows()

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInPandas(count, "word binary, gram long, n long")
    return counts.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def suffixes(gram: Column, order: int) -> Column:
    """The last bytes of a gram at every order k, as one number below a leading 1: (k, key)."""
    return F.explode(
        F.array(*(F.struct(F.lit(k).alias("k"), gram.bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).bitwiseOR(F.lit(1 << 8 * (k + 1))).alias("key")) for k in range(order + 1)))
    )


def context_of(key: Column) -> Column:
    return F.shiftright(key, 8)


def trie(grams: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (k, key, n) of all orders, and contexts (k, context, total, distinct, lower).

    `lower` is the count that the context's symbols have in the next shorter context."""
    last = lambda k: F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
    nodes, level = None, grams
    for k in range(order, -1, -1):
        # Each order is a sum of the one above, which has more rows.
        level = written(level.groupBy(last(k).alias("gram")).agg(F.sum("n").alias("n"))) if k < order else grams
        found = level.select(F.lit(k).alias("k"), F.col("gram").bitwiseOR(F.lit(1 << 8 * (k + 1))).alias("key"), "n")
        nodes = found if nodes is None else nodes.unionByName(found)
    shorter = F.element_at(
        F.array(*(F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)).bitwiseOR(F.lit(1 << 8 * k)) for k in range(order + 1))), F.col("k") + 1
    )
    below = nodes.select((F.col("k") + 1).alias("k"), F.col("key").alias("shorter"), F.col("n").alias("n_below"))
    linked = nodes.withColumn("shorter", shorter).join(below, ["k", "shorter"], "left")
    contexts = linked.groupBy("k", context_of(F.col("key")).alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("distinct"), F.coalesce(F.sum("n_below"), F.lit(0)).alias("lower")
    )
    return nodes, written(contexts)


def seen_prices(nodes: DataFrame, contexts: DataFrame, order: int) -> DataFrame:
    """(gram, n, price): log10 prices of the grams of the training texts."""
    longest = nodes.filter(F.col("k") == order).withColumn("context", context_of(F.col("key")))
    whole = F.col("total") + F.when(F.col("distinct") == 256, 0).otherwise(F.col("distinct"))
    gram = F.col("key").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))
    return longest.join(contexts.filter(F.col("k") == order).drop("k"), "context").select(
        gram.alias("gram"), "n", F.log10(F.col("n") / whole).alias("price")
    )


def unseen_prices(grams: DataFrame, nodes: DataFrame, contexts: DataFrame, order: int) -> DataFrame:
    """(gram, price) of distinct grams that are not in the training texts."""
    asked = grams.select("gram", suffixes(F.col("gram"), order).alias("s")).select("gram", "s.*")
    asked = asked.withColumn("context", context_of(F.col("key")))

    def looked_up(low: bool) -> DataFrame:
        part = (F.col("k") < SMALL_ORDERS) if low else (F.col("k") >= SMALL_ORDERS)
        sides = [nodes.filter(part), contexts.filter(part)]
        by_node, by_context = (F.broadcast(s) for s in sides) if low else sides
        return asked.filter(part).join(by_context, ["k", "context"], "left").join(by_node, ["k", "key"], "left")

    found = looked_up(True).unionByName(looked_up(False))
    per_order = lambda name, k: F.coalesce(F.max(F.when(F.col("k") == k, F.col(name))), F.lit(0)).alias(f"{name}{k}")
    wide = found.groupBy("gram").agg(*(per_order(c, k) for c in ("n", "total", "distinct", "lower") for k in range(order + 1)))
    zero = F.lit(0)
    rest, price, excluded, taken = F.lit(1.0), F.lit(None).cast("double"), zero, zero
    for k in range(order, -1, -1):
        n, total, distinct = F.col(f"n{k}"), F.col(f"total{k}"), F.col(f"distinct{k}")
        wide = wide.withColumns(
            {
                f"price{k}": F.coalesce(price, F.when(n > 0, rest * n / (total - taken + F.when(distinct == 256, 0).otherwise(distinct - excluded)))),
                f"rest{k}": F.when(distinct == excluded, rest)
                .when(distinct == 256, 0.0)
                .otherwise(rest * (distinct - excluded) / (total - taken + distinct - excluded)),
            }
        )
        price, rest, excluded, taken = F.col(f"price{k}"), F.col(f"rest{k}"), distinct, F.col(f"lower{k}")
    return wide.select("gram", F.log10(F.coalesce(price, rest / (256 - excluded))).alias("price"))


def _scorer(hot_grams: np.ndarray, prices: np.ndarray, hot: dict[bytes, float], order: int):
    def scan(texts: list[bytes | None]) -> Iterator[tuple]:
        for text in texts:
            text = text or b""
            words = Counter(space_words(text))
            words[END] += 1
            known, score, rare = 0, 0.0, []
            for word, n in words.items():
                value = hot.get(word)
                if value is None:
                    rare.append((word, n))
                else:
                    known += n
                    score += n * value
            keys, times = np.unique(grams_of(text, order), return_counts=True)
            at = np.searchsorted(hot_grams, keys)
            at[at == len(hot_grams)] = 0
            hit = hot_grams[at] == keys if len(hot_grams) else np.zeros(len(keys), bool)
            priced = float((prices[at[hit]] * times[hit]).sum())
            yield words.total(), known, score, priced, rare, keys[~hit], times[~hit]

    return scan


def frequent(counts: DataFrame, most: int, size: Column | None = None, most_bytes: int = 0) -> DataFrame:
    """The rows with the largest `n`: as many steps of it (16 to a power of two) as have `most` rows together."""
    step = F.floor(F.log2("n") * 16)
    sizes = F.sum(size if size is not None else F.lit(0))
    least, rows, held = None, 0, 0
    for found in counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), sizes.alias("bytes")).orderBy(F.desc("step")).collect():
        rows, held = rows + found["rows"], held + found["bytes"]
        if rows > most or held > most_bytes:
            break
        least = found["step"]
    return counts.filter(step >= least) if least is not None else counts.limit(0)


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """A row per document: its tokens, how many are known, the unigram and the model's score."""
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    counts = written(gathered(rows.filter(~F.col("held_out")), order))
    words = counts.filter("word is not null").select("word", "n")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    denominator = totals.tokens + totals.distinct + 1
    nodes, contexts = trie(counts.filter("gram is not null").select("gram", "n"), order)
    seen = written(seen_prices(nodes, contexts, order))
    common = frequent(seen, HOT_GRAMS).select("gram", "price").toArrow()
    by_gram = np.argsort(common["gram"].to_numpy())
    hot_grams, prices = common["gram"].to_numpy()[by_gram], common["price"].to_numpy()[by_gram]
    top = frequent(words.filter(F.octet_length("word") <= HOT_BYTES), HOT_WORDS, F.octet_length("word"), HOT_WORD_BYTES).toPandas()
    hot = {bytes(w): math.log10((n + 1) / denominator) for w, n in zip(top["word"], top["n"])}

    scan = struct_udf(_scorer(hot_grams, prices, hot, order), SCHEMA)(F.col("text").cast("binary"))
    made = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", scan.alias("s"))
    made = written(made.select("row", "doc_id", "held_out", "s.*"))
    rare = made.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    priced = rare.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / denominator)).alias("rare_score"),
    )
    cold = made.select("row", F.explode(F.arrays_zip("grams", "times")).alias("r")).select("row", F.col("r.grams").alias("gram"), "r.times")
    unseen = written(cold.select("gram").distinct().join(seen, "gram", "left_anti"))
    every = seen.select("gram", "price").unionByName(unseen_prices(unseen, nodes, contexts, order))
    cold = cold.join(every, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("price")).alias("cold_score"))
    return made.drop("rare", "grams", "times").join(priced, "row", "left").join(cold, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("cold_score", F.lit(0.0))).alias("score"),
    )
