"""Spelling variants: words one edit apart, grouped under the far more frequent form.

Words are counted first; a batch of texts gives partial counts, so frequent words cost a row per
batch.  Two words are near if they differ by one inserted, deleted or replaced code point.  The
neighbourhoods are found by probing:

1. The vocabulary goes into blocked Bloom filters, one or more for each word length (a block is a
   64-bit word in which a key sets `BITS_SET` bits, so a probe reads one place).
2. Every word generates its edits: each deletion, probed in the filter of the next shorter length,
   and each replacement by a later letter, probed in its own length's.  Insertions and earlier
   letters are the same pairs seen from the other word.  An edit's hash follows from the word's by
   arithmetic, so only positives become strings.
3. Only positives are shuffled; an exact join with the vocabulary removes the false ones.

Filters are broadcast, and their size is bounded: at most `PASS_WORDS` words are in the filters of
one pass, and a larger vocabulary takes several passes over its words.  A length with many words
has several filters, chosen by the hash.

A word's form is its most frequent near word, if that is `FACTOR` times as frequent; forms are
followed to the root by doubling.

A null text has no words, a null id is an empty one, runs of letters are taken whole however long,
and repeated rows count each time.  Of near words with equal counts the smallest is the form.  An
empty table has no words.  Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casario.llm.common import written

MIN_LETTERS = 6
MIN_COUNT = 5
#: A form is this many times as frequent as its variant at least.
FACTOR = 5
#: Runs whose crc32 (with the id) this divides lose a letter before they are counted.
BLUR = 199
#: Bits of a filter per word, and bits that a word sets in its block.
BITS_PER_WORD = 24
BITS_SET = 5
#: Words in one filter, which a task builds, and in all filters that are broadcast together (72 MB).
SHARD_WORDS = 1 << 12
PASS_WORDS = 24 << 20
#: Words that a task probes, at a guess.
TASK_WORDS = 50_000
#: Distinct words that a task counts before it passes them on, and probes at a time; bound memory, not results.
HELD_WORDS = 500_000
CHUNK_PROBES = 1 << 19

# One byte a letter: the letters are those of Latin-1, and any other character is a break.
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % MIN_LETTERS)


def blurred(doc_id: str, run: bytes, every: int) -> bytes:
    """The run as it is counted: a few lose one letter."""
    h = crc32(f"{doc_id}:{run.decode('latin-1')}".encode())
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def _counts(blur: int | None):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                if text is None:
                    continue
                for run, n in Counter(_RUN.findall(text.encode("latin-1", "replace").lower())).items():
                    word = blurred(doc_id, run, blur) if blur else run
                    if len(word) >= MIN_LETTERS:
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield _frame(total)
                    total.clear()
        yield _frame(total)

    return count


def _frame(total: Counter[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"word": pd.Series([w.decode("latin-1") for w in total], dtype=object), "n": list(total.values())})


def vocabulary(docs: DataFrame, blur: int | None = BLUR) -> DataFrame:
    """(word, n) of all words with MIN_COUNT occurrences."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = rows.mapInPandas(_counts(blur), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= MIN_COUNT)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def letter_value(at: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to its word's hash, before `_mixed`."""
    return _mixed(at.astype(np.uint64) * np.uint64(256) + letter.astype(np.uint64) + np.uint64(1))


def word_matrix(words: list[bytes]) -> np.ndarray:
    """Letters of words of one length, a row a word."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def hashes(words: list[bytes]) -> np.ndarray:
    """Hash of each word."""
    out = np.empty(len(words), np.uint64)
    for rows, letters in by_length(words):
        out[rows] = _mixed(letter_value(np.arange(letters.shape[1]), letters).sum(axis=1, dtype=np.uint64))
    return out


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters) for words of one length, as many as fit a chunk."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        step = max(1, CHUNK_PROBES // int(lengths[rows[0]]))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            yield part, word_matrix([words[r] for r in part])


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (_mixed(h) % np.uint64(shards)).astype(np.int64)


def _bits(h: np.ndarray) -> np.ndarray:
    """The bits that a key sets in its block, from the low half of its hash."""
    mask = np.zeros(len(h), np.uint64)
    for k in range(BITS_SET):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return mask


def _block(h: np.ndarray, blocks: np.ndarray | np.uint64) -> np.ndarray:
    return ((h >> np.uint64(32)) * blocks) >> np.uint64(32)


def bloom(h: np.ndarray) -> np.ndarray:
    """The blocked filter of some keys."""
    out = np.zeros(max(1, -(-len(h) * BITS_PER_WORD // 64)), np.uint64)
    np.bitwise_or.at(out, _block(h, np.uint64(len(out))), _bits(h))
    return out


@dataclass
class Filters:
    """The filters of one word length, put together: where each shard's begins and how many blocks it has."""

    starts: np.ndarray
    sizes: np.ndarray
    blocks: np.ndarray

    @classmethod
    def of(cls, shards: int, parts: dict[int, bytes]) -> Filters:
        """Those of the shards at hand; the others hold nothing."""
        sizes = np.array([len(parts.get(k, b"")) // 8 for k in range(shards)], np.uint64)
        blocks = np.frombuffer(b"".join(parts[k] for k in sorted(parts)), np.uint64)
        return cls(np.cumsum(sizes) - sizes, sizes, blocks)

    def hold(self, h: np.ndarray) -> np.ndarray:
        """Which keys may be in the filters."""
        shard = shard_of(h, len(self.sizes)) if len(self.sizes) > 1 else np.zeros(len(h), np.int64)
        sizes, bits = self.sizes[shard], _bits(h)
        found = self.blocks[np.minimum(self.starts[shard] + _block(h, sizes), np.uint64(len(self.blocks) - 1))]
        return (found & bits == bits) & (sizes > 0)


def probed(letters: np.ndarray, filters: dict[int, Filters], alphabet: bytes) -> Iterator[tuple[int, bytes]]:
    """(row, edit) of the generated edits that the filters let through, for words of one length."""
    n, length = letters.shape
    places = np.arange(length)
    value = letter_value(places, letters)
    whole = value.sum(axis=1, dtype=np.uint64)
    if length - 1 in filters:
        # Without the letter at i: what stands before it, and what follows one place to the left.
        left = np.cumsum(value, axis=1, dtype=np.uint64) - value
        moved = letter_value(places[:-1], letters[:, 1:]) if length > 1 else value[:, :0]
        right = np.zeros_like(value)
        right[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        # Of equal letters in a row the last one stands for all.
        once = np.ones(letters.shape, bool)
        once[:, :-1] = letters[:, :-1] != letters[:, 1:]
        rows, at = np.nonzero(once)
        found = filters[length - 1].hold(_mixed((left + right)[rows, at]))
        for row, i in zip(rows[found].tolist(), at[found].tolist()):
            word = letters[row].tobytes()
            yield row, word[:i] + word[i + 1 :]
    if length in filters:
        for letter in alphabet:
            rows, at = np.nonzero(letters < letter)
            changed = whole[rows] - value[rows, at] + letter_value(places, np.full(length, letter))[at]
            found = filters[length].hold(_mixed(changed))
            for row, i in zip(rows[found].tolist(), at[found].tolist()):
                word = letters[row].tobytes()
                yield row, word[:i] + bytes((letter,)) + word[i + 1 :]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of near words once, from a written table (word, n)."""
    spark = words.sparkSession
    lengths = {r.length: r.words for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words")).collect()}
    shards = {length: -(-n // SHARD_WORDS) for length, n in lengths.items()}

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            listed = [w.encode("latin-1") for w in batch["word"]]
            h = hashes(listed)
            length = np.fromiter(map(len, listed), np.int64, len(listed))
            shard = np.zeros(len(h), np.int64)
            for one in np.unique(length):
                if shards[one] > 1:
                    shard[length == one] = shard_of(h[length == one], shards[one])
            letters = [bytes(sorted(set(b"".join(listed))))] + [b""] * (len(h) - 1)
            yield pd.DataFrame({"length": length, "shard": shard, "h": h.view(np.int64), "letters": letters[: len(h)]})

    def build(key: tuple[int, int], rows: pd.DataFrame) -> pd.DataFrame:
        letters = bytes(sorted(set(b"".join(rows["letters"]))))
        return pd.DataFrame({"length": [key[0]], "shard": [key[1]], "bits": [bloom(rows["h"].to_numpy().view(np.uint64)).tobytes()], "letters": [letters]})

    hashed = words.select("word").mapInPandas(keys, "length long, shard long, h long, letters binary")
    made = hashed.groupBy("length", "shard").applyInPandas(build, "length long, shard long, bits binary, letters binary")
    built = written(made)
    alphabet = bytes(sorted({c for r in built.select("letters").distinct().collect() for c in r.letters}))
    # Passes over lengths and shards, each with filters of PASS_WORDS words or fewer.
    passes, room = [[]], PASS_WORDS
    for length, n in sorted(lengths.items()):
        each = -(-n // shards[length])
        for shard in range(shards[length]):
            if room < each and passes[-1]:
                passes.append([])
                room = PASS_WORDS
            passes[-1].append((length, shard))
            room -= each

    def probing(sent):
        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts: dict[int, dict[int, bytes]] = {}
            for length, shard, bits in sent.value:
                parts.setdefault(length, {})[shard] = bits
            filters = {length: Filters.of(shards[length], found) for length, found in parts.items()}
            for batch in batches:
                listed = [w.encode("latin-1") for w in batch["word"]]
                counts = batch["n"].to_numpy()
                for rows, letters in by_length(listed):
                    found = list(probed(letters, filters, alphabet))
                    at = rows[[r for r, _ in found]].tolist() if found else []
                    word = pd.Series([listed[k].decode("latin-1") for k in at], dtype=object)
                    other = pd.Series([w.decode("latin-1") for _, w in found], dtype=object)
                    yield pd.DataFrame({"word": word, "n": counts[np.array(at, np.int64)], "other": other})

        return probe

    positives = []
    for chosen in passes if lengths else []:
        wanted = spark.createDataFrame(chosen, "length long, shard long")
        sent = spark.sparkContext.broadcast([tuple(r) for r in built.join(F.broadcast(wanted), ["length", "shard"]).select("length", "shard", "bits").collect()])
        spread = words.repartition(max(4 * spark.sparkContext.defaultParallelism, sum(lengths.values()) // TASK_WORDS), "word")
        positives.append(written(spread.mapInPandas(probing(sent), "word string, n long, other string")))
        sent.destroy()
    if not positives:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n"))
    candidates = positives[0]
    for more in positives[1:]:
        candidates = candidates.unionByName(more)
    return candidates.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) for the (word, form) rows: forms followed to their end, the distance doubling."""
    roots = written(forms.select("word", F.col("form").alias("root")))
    while True:
        far = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = written(roots.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def variants(docs: DataFrame, blur: int | None = BLUR) -> DataFrame:
    """A row per word: its count, its form and that one's count (null if none), the root that forms
    lead to, and how many words are near."""
    words = written(vocabulary(docs, blur))
    pairs = near_words(words)
    both = F.array(F.struct(F.col("word").alias("word"), F.col("other").alias("other"), F.col("other_n").alias("n")),
                   F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("n")))
    seen = pairs.select(F.inline(both))
    best = F.min(F.struct((-F.col("n")).alias("less"), "other"))
    stats = seen.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = words.join(stats, "word", "left")
    frequent = -F.col("best.less") >= FACTOR * F.col("n")
    told = written(told.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
    ))
    roots = followed(told.filter("form is not null"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
