"""Quality rules by suffix array: how much of a text repeats itself, and for how long.

Words are compared exactly.  Windows of `REPEAT_WORDS` words that occur twice are found for
many documents at once by doubling: equal pairs, then equal pairs of equal pairs, each round
only on what still has an equal.  A document without such a window has no repeat to measure.
The others get a suffix array with its longest common prefixes; the intervals of these are
the maximal repeated substrings, whose spans are united.

Nulls, empty texts: no words, so too few of them: rejected.  Equal rows are judged alike.  Texts are
measured whole, however long; an empty table gives no rows; columns other than `doc_id` and `text`
may have any name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.llm.common import findings, struct_udf

MIN_WORDS = 20
REPEAT_WORDS = 8
#: Percent of words in windows found twice or more.
REPEAT_PERCENT = 30
#: Limits of the method: share of the word characters inside repeated substrings, and the
#: longest repeat as a share of the words (only for repeats of MIN_LONGEST words or more).
#: Both are below what REPEAT_PERCENT implies, as repeats cover the words of the windows.
#: At most 0.3 % of the documents labelled good at sf0.1 are above them.
MAX_COVERED = 0.2
MAX_LONGEST = 0.1
MIN_LONGEST = 25
#: Words that are doubled together; bounds memory, not results.
CHUNK_WORDS = 400_000

_SPACE_AND_TAILS = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered double, longest long, n_repeats long"
)


def repeated_windows(ids: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Positions where a window of `width` (a power of two) words starts that its document has twice."""
    n, h = len(ids), 1
    rank = np.unique(doc * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)[1]
    at = np.arange(n)
    while h < width and len(at):
        at = at[at + h < n]
        at = at[(doc[at] == doc[np.minimum(at + 2 * h - 1, n - 1)]) & (at + 2 * h <= n) & (rank[at] >= 0) & (rank[at + h] >= 0)]
        _, group, size = np.unique(rank[at] * np.int64(n + 1) + rank[at + h], return_inverse=True, return_counts=True)
        twice = size[group] > 1
        at, group = at[twice], group[twice]
        rank = np.full(n, -1, np.int64)
        rank[at] = group
        h *= 2
    return at


def suffix_array(ids: np.ndarray) -> np.ndarray:
    n, h = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - h)] = rank[h:]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_keys = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([1], 1 + np.cumsum(sorted_keys[1:] != sorted_keys[:-1])))
        if n == 0 or rank[order[-1]] == n or h >= n:
            return order
        h *= 2


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """Words that each suffix shares with the one before it in the suffix array."""
    n = len(ids)
    place, out, h = [0] * n, [0] * n, 0
    for i, p in enumerate(order):
        place[p] = i
    for p in range(n):
        if place[p] == 0:
            h = 0
            continue
        q = order[place[p] - 1]
        while p + h < n and q + h < n and ids[p + h] == ids[q + h]:
            h += 1
        out[place[p]] = h
        h = max(0, h - 1)
    return out


def repeated_spans(ids: np.ndarray, least: int) -> tuple[np.ndarray, int, int]:
    """Which words lie in a repeat of `least` words or more; the longest repeat; how many
    intervals of the common prefixes (maximal repeated substrings to the right) there are."""
    n = len(ids)
    order = suffix_array(ids)
    prefix = np.array(common_prefixes(ids.tolist(), order.tolist()), np.int64)
    reach = np.maximum(prefix, np.append(prefix[1:], 0))
    marks = np.zeros(n + 1, np.int64)
    long_enough = reach >= least
    np.add.at(marks, order[long_enough], 1)
    np.add.at(marks, order[long_enough] + reach[long_enough], -1)
    intervals, open_ = 0, [0]
    for height in prefix.tolist():
        while open_[-1] > height:
            intervals += open_.pop() >= least
        if open_[-1] < height:
            open_.append(height)
    intervals += sum(h >= least for h in open_)
    return np.cumsum(marks[:-1]) > 0, int(reach.max(initial=0)), int(intervals)


def _measure(texts: list[bytes], words: list[list[bytes]]) -> Iterator[tuple]:
    """Findings of a few documents whose words fit one chunk."""
    number = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter((number[x] for w in words for x in w), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(words)), sizes)
    first = np.concatenate(([0], np.cumsum(sizes)))
    at = repeated_windows(ids, doc, REPEAT_WORDS)
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + REPEAT_WORDS, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(marks[:-1]) > 0)))
    in_windows = inside[first[1:]] - inside[first[:-1]]
    for k, text in enumerate(texts):
        n, repeats = int(sizes[k]), int(in_windows[k])
        word_chars = len(text.translate(None, _SPACE_AND_TAILS))
        seen, dup_lines = set(), 0
        for line in text.split(b"\n"):
            if line in seen:
                dup_lines += bool(line.split())
            else:
                seen.add(line)
        covered, longest, intervals = 0.0, 0, 0
        if repeats:
            spans, longest, intervals = repeated_spans(ids[first[k] : first[k + 1]], REPEAT_WORDS)
            chars = sum(len(w.decode()) for w, hit in zip(words[k], spans) if hit)
            covered = chars / word_chars
        failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
        repetitive = covered > MAX_COVERED or longest >= MIN_LONGEST and longest > MAX_LONGEST * n
        symbols = len(text) - len(text.translate(None, _SYMBOLS))
        yield (n, word_chars, symbols, dup_lines, repeats, failed, not (failed or repetitive), covered, longest, intervals)


def scan(texts: list[bytes | None]) -> Iterator[tuple]:
    held, words, total = [], [], 0
    for text in texts:
        held.append(text or b"")
        words.append(held[-1].split())
        total += len(words[-1])
        if total > CHUNK_WORDS:
            yield from _measure(held, words)
            held, words, total = [], [], 0
    if held:
        yield from _measure(held, words)


def quality(text: str | Column = "text") -> Column:
    """Struct of SCHEMA for a text column."""
    return struct_udf(scan, SCHEMA)(F.col(text).cast("binary") if isinstance(text, str) else text)


def quality_report(docs: DataFrame) -> DataFrame:
    """A row per document: its measures and the verdict."""
    return findings(docs, quality())


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return docs.filter(quality()["kept"])
