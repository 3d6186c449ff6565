"""Benchmark decontamination with a generalised suffix automaton over test items.

The automaton holds every word sequence of the normalised items.  A document streams through
it word by word; the state knows the longest suffix of the document so far that some item
contains.  From `WINDOW` words on, that suffix ends in a window of an item: its words are
hit, and the state's window owner lists the items.  Items shorter than a window match whole.

The items are the broadcast side.  They are read into one automaton per `SHARD_BYTES` of
item text, so what an executor holds is bounded; several automata pass over the documents
one after the other and their spans are united.

A null or empty text has no words.  Items without words match nothing.  Rows of the
benchmark with the same item_id are one item; a null item_id is named by the empty string.  Texts are read whole, however
long; repeated documents get equal rows; without documents there are no rows, without items no
hits.  Columns not named here may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casario.llm.common import alnum_words, packed, struct_udf, unpacked, written

#: Words of a window.
WINDOW = 10
#: Bytes of item text in one automaton.
SHARD_BYTES = 1 << 20
#: Items longer than this are entered in pieces that overlap by all but one word of a window.
PIECE_WORDS = 20_000

SCHEMA = "n_words long, longest long, spans array<struct<start:long,stop:long>>, items array<string>"


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the owners of their windows."""

    def __init__(self, items: list[tuple[str, list[bytes], bool]], window: int = WINDOW):
        """`items`: name, words, and whether the words are a whole short item."""
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.window = [-1], [0], window
        for _, words, _ in items:
            state = 0
            for w in words:
                state = self._extend(state, w)
        #: For a state, the one on its suffix path whose strings span the window length.
        self.owner = [0] * len(self.step)
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            if self.length[s] >= window:
                self.owner[s] = s if self.length[self.link[s]] < window else self.owner[self.link[s]]
        self.items: dict[int, set[str]] = {}
        own_short: dict[int, list[tuple[int, str]]] = {}
        for name, words, short in items:
            state = 0
            for k, w in enumerate(words, 1):
                state = self.step[state][w]
                if k >= window and not short:
                    self.items.setdefault(self.owner[state], set()).add(name)
            if short:
                own_short.setdefault(state, []).append((len(words), name))
        #: Short items that end where a state ends, shortest path first.
        self.short: dict[int, list[tuple[int, str]]] = {}
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__) if own_short else ():
            if found := self.short.get(self.link[s], []) + own_short.get(s, []):
                self.short[s] = found
        self.least = min([window, *(n for found in own_short.values() for n, _ in found)])

    def _new(self, length: int, link: int, step: dict[bytes, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, w: bytes) -> int:
        """The state that p reaches by w, with p's strings extended by w as its longest."""
        q = self.step[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.step[last]:
            return self._split(last, w)
        state, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, w)
        return state

    def match(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Longest match, disjoint hit spans (word positions), and items with a hit."""
        step, link, length, least, window = self.step, self.link, self.length, self.least, self.window
        state = size = longest = 0
        hit, items = None, set()
        for i, w in enumerate(words):
            following = step[state].get(w)
            while following is None and state:
                state = link[state]
                size = length[state]
                following = step[state].get(w)
            if following is None:
                continue
            state = following
            size += 1
            if size > longest:
                longest = size
            if size >= least:
                if hit is None:
                    hit = bytearray(len(words))
                if size >= window:
                    hit[i - window + 1 : i + 1] = b"\1" * window
                    items |= self.items.get(self.owner[state], ())
                for n, name in self.short.get(state, ()):
                    if n <= size:
                        hit[i - n + 1 : i + 1] = b"\1" * n
                        items.add(name)
        spans = []
        if hit:
            start = hit.find(1)
            while start >= 0:
                stop = hit.find(0, start)
                stop = len(hit) if stop < 0 else stop
                spans.append((start, stop))
                start = hit.find(1, stop)
        return longest, spans, items


def pieces(items: DataFrame) -> DataFrame:
    """Items with words, cut into (name, piece, short) rows of at most PIECE_WORDS words."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, text in zip(batch["name"], batch["text"]):
                words = alnum_words(text)
                for k in range(0, max(1, len(words) - WINDOW + 1), PIECE_WORDS):
                    if words:
                        out.append((name, b" ".join(words[k : k + PIECE_WORDS + WINDOW - 1]), len(words) < WINDOW))
            yield pd.DataFrame(out, columns=["name", "piece", "short"])

    return items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("binary").alias("text")
    ).mapInPandas(cut, "name string, piece binary, short boolean")


def _matcher(index: SuffixAutomaton):
    def scan(texts: list[bytes | None]) -> Iterator[tuple]:
        for text in texts:
            words = alnum_words(text)
            longest, spans, items = index.match(words)
            yield len(words), longest, spans, sorted(items)

    return struct_udf(scan, SCHEMA)


def _united(found: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for spans in found for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


def matches(docs: DataFrame, items: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc, match): the documents' columns as a struct, and SCHEMA.

    Spans are word positions, stop exclusive."""
    cut = written(pieces(items))
    total = cut.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0)).alias("n")).first().n
    shards = max(1, -(-total // shard_bytes))

    def automaton(k: int) -> SuffixAutomaton:
        rows = cut.filter(F.pmod(F.xxhash64("name", "piece"), F.lit(shards)) == k).collect()  # shard_bytes of text
        return SuffixAutomaton([(r.name, bytes(r.piece).split(), r.short) for r in sorted(rows, key=lambda r: (r.name, r.piece))])

    if shards == 1:
        return packed(docs, match=_matcher(automaton(0))(F.col(text).cast("binary")))
    kept = written(packed(docs, row=F.monotonically_increasing_id()))
    found = None
    for k in range(shards):
        part = written(kept.select("row", _matcher(automaton(k))(F.col("doc")[text].cast("binary")).alias("m")))
        found = part if found is None else found.unionByName(part)
    unite = F.udf(_united, "array<struct<start:long,stop:long>>")
    merged = found.groupBy("row").agg(
        F.struct(
            F.max("m.n_words").alias("n_words"),
            F.max("m.longest").alias("longest"),
            unite(F.collect_list("m.spans")).alias("spans"),  # one list for each automaton
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("m.items")))).alias("items"),
        ).alias("match")
    )
    return kept.join(merged, "row").drop("row")


def hit_words() -> F.Column:
    return F.aggregate("match.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row per document: words, hit words, items with occurring windows, longest match."""
    return matches(docs.select("doc_id", "text"), items).select(
        "doc.doc_id",
        F.col("match.n_words").alias("n_words"),
        hit_words().alias("n_hit"),
        F.size("match.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("match.items", ","), 256).alias("items_sha256"),
        (hit_words() > 0).alias("contaminated"),
        F.col("match.longest").alias("longest"),
        F.col("match.spans").alias("spans"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, max_words: int = 0, max_coverage: float = 0.0) -> DataFrame:
    """The documents without test passages.

    A hit span of more than `max_words` words is removed from `text`.  A document of whose
    words more than `max_coverage` are hit is dropped as a whole; with the default 0 every
    document with a hit goes.  A text keeps everything outside its removed spans.
    """

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, [s for s in found if s["stop"] - s["start"] > max_words]) for t, found in zip(texts, spans)])

    found = matches(docs, items)
    kept = found.filter(hit_words() <= F.lit(max_coverage) * F.col("match.n_words"))
    if max_coverage > 0:
        text = F.when(F.size("match.spans") > 0, without(F.col("doc")["text"], "match.spans")).otherwise(F.col("doc")["text"])
        kept = kept.withColumn("doc", F.col("doc").withField("text", text))
    return unpacked(kept, docs)


def cut_words(text: str | None, spans: list) -> str | None:
    """The text without the words of the spans; what stands between words stays outside them."""
    if not text or not spans:
        return text
    raw = text.encode()
    borders, inside = [], False
    for k, b in enumerate(raw):
        word = b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122
        if word != inside:
            borders.append(k)
            inside = word
    if inside:
        borders.append(len(raw))
    out, end = [], 0
    for s in spans:
        out.append(raw[end : borders[2 * s["start"]]])
        end = borders[2 * s["stop"] - 1]
    return b"".join([*out, raw[end:]]).decode()


def items_digest(items: list[str]) -> str:
    """The digest of `items_sha256`, for callers outside Spark."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
