"""Spelling variants against a comparison of all words with all others."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from casario.llm import spelling
from llm.samples import awkward, clashing, frame


def near(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    neighbours = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(neighbours[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(neighbours[w]), words.get(form[w])))
    return out


def check(spark, rows, change=lambda docs: docs):
    got = [tuple(r) for r in spelling.variants(change(frame(spark, rows))).collect()]
    want = variants_brute(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    return want


def typos(seed: int, n_words: int, n_docs: int):
    """Texts of few words, many of them with an edit or two, so that chains of forms occur."""
    dice = random.Random(seed)
    letters = "abcdeéÿ"
    base = ["".join(dice.choice(letters) for _ in range(dice.randrange(6, 10))) for _ in range(n_words)]

    def worn(word):
        while dice.random() < 0.4:
            k, kind = dice.randrange(len(word)), dice.randrange(3)
            word = word[:k] + dice.choice(["", dice.choice(letters), dice.choice(letters) + word[k]][kind:]) + word[k + 1 :]
        return word.upper() if dice.random() < 0.1 else word

    text = lambda: " ".join(worn(base[min(dice.randrange(n_words), dice.randrange(n_words))]) for _ in range(200))
    return [(k, text(), "en", "s", 1) for k in range(n_docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, seed):
    chain = " ".join(["chainaaa"] * 200 + ["chainaab"] * 30 + ["chainabb"] * 6)
    want = check(spark, [*typos(seed, 12, 120), (500, chain, "en", "s", 1)])
    assert any(form and root != form for _, form, root, *_ in want)
    assert any("é" in w for w, *_ in want) and sum(near for *_, near, _ in want) > 50


def test_several_filters_and_passes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SHARD_WORDS", 7)
    monkeypatch.setattr(spelling, "PASS_WORDS", 30)
    monkeypatch.setattr(spelling, "CHUNK_PROBES", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    check(spark, typos(3, 12, 60))


def test_awkward_rows(spark):
    long = "a" * 30_000
    rows = awkward() + [(200 + k, f"{long} {long[:-1]} {long}b Ünïted ünïted {'same ' * 20}", "en", "s", 1) for k in range(6)]
    check(spark, rows)
    check(spark, rows, clashing)
    check(spark, rows * 5)
    assert check(spark, []) == []


def test_filters_lose_nothing_and_rarely_err():
    dice = random.Random(5)
    word = lambda: bytes(dice.choice(b"abcdefghijklmnopqrstuvwxyz\xe9\xfc") for _ in range(8))
    inside, outside = [word() for _ in range(20_000)], [word() for _ in range(20_000)]
    blocks = spelling.Filters.of(1, {0: spelling.bloom(spelling.hashes(inside)).tobytes()})
    assert blocks.hold(spelling.hashes(inside)).all()
    assert np.mean(blocks.hold(spelling.hashes(outside))) < 0.01
