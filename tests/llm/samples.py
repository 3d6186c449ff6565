"""Small awkward inputs, and words to make texts of."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    dice = random.Random(seed)
    return " ".join(f"w{dice.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    dice, out = random.Random(seed), text.split()
    for _ in range(changes):
        out[dice.randrange(len(out))] = f"x{dice.randrange(10**6)}"
    return " ".join(out)


def awkward() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies."""
    base = words(1, 120)
    texts = [
        None, "", " \n\t ", "one", "two words", base, base, edited(base, 5, 2), edited(base, 6, 3), edited(base, 7, 30),
        "A" * 300_000, words(2, 60_000, 5000), "ä ö ü é \u00a0 \u2003 \x1c x" * 30, "12 " * 3000, "@" * 2000 + "a.b",
        "same line\n" * 50, words(3, 40) + "\n" + words(4, 40), "\U0001f600 " * 40 + words(8, 25), "i\u0307 \u0130 ß K ſ" * 10,
    ]
    rows = [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, None, None, None), (None, None, None, None, None), (100, words(9, 50), None, "s0", 3)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def clashing(docs):
    """The same rows with extra columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    names = ["doc", "n", "value", "s", "row", "word", "match", "slot", "start", "shard", "_hash", "kept", "found", "print", "at", "of_id", "id"]
    return docs.select("*", *(F.lit(7).alias(n) for n in names))
