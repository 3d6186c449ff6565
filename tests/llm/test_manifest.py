"""The manifest against a hash tree built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from casario.llm import manifest
from llm.samples import awkward, clashing, frame


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    doc_id, text, lang, source, n_chars = row
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest(*("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """Root, and for each node its siblings before and after it, level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(proofs):
            run, pos = at[k] // 8 * 8, at[k] % 8
            path.append((nodes[run : run + pos], nodes[run + pos + 1 : run + 8]))
            at[k] //= 8
        nodes = [digest(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], proofs


def lowered(row):
    text = row[1] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1])
    return (row[0], text, *row[2:])


def manifest_brute(rows):
    first = lambda value: (value is not None, value if value is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (first(r[0]), leaf(r))) for lang in langs]
    trees = [tree([leaf(r) for r in group]) for group in groups]
    if not trees:
        return []
    root, above = tree([subroot for subroot, _ in trees])
    out = []
    for group, (subroot, proofs), rest in zip(groups, trees, above):
        for row, proof in zip(group, proofs):
            touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            fold = leaf(lowered(row) if touched else row)
            for before, after in proof + rest:
                fold = digest(*before, fold, *after)
            siblings = [d for before, after in proof + rest for d in before + after]
            out.append((row[0], leaf(row), subroot, root, digest(*siblings), fold, fold == root))
    return out


def both(spark, rows, change=lambda docs: docs):
    key = lambda row: tuple(map(str, row))
    got = manifest.checked(change(frame(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(manifest_brute(rows), key=key)


def small(n, lang=lambda k: "en"):
    return [(k * 7 % n, f"Text {k}" if k % 3 else f"text {k}", lang(k), "s", k) for k in range(n)]


@pytest.mark.parametrize("n", [0, 1, 8, 65, 700])
def test_one_language(spark, n):
    both(spark, small(n))


def test_languages_of_every_size(spark):
    sizes = [1, 1, 600, 8, 9, 1, 65, 3, 1, 20]
    rows = [(100 * g + k, f"T{k}", f"l{g}" if g else None, None, k) for g, n in enumerate(sizes) for k in range(n)]
    both(spark, rows)


def test_many_lone_languages(spark):
    both(spark, small(150, lambda k: f"lang {k}"))


def test_awkward_rows(spark):
    both(spark, awkward())
    both(spark, awkward(), clashing)


def test_repeated_rows_over_several_files(spark):
    rows = small(40) + [(7, "Copy", "en", "s", 1)] * 300 + [(7, "Dopy", "en", "s", 1)] * 300
    both(spark, rows, lambda docs: docs.repartition(13))


def test_proofs_tell_a_changed_row(spark):
    rows = [(k, f"{'Upper' if k % 2 else 'lower'} {k}", "en", "s", k) for k in range(200)]
    touched = {k for k in range(200) if zlib.crc32(str(k).encode()) % 3 == 0 and k % 2}
    assert {r.doc_id for r in manifest.checked(frame(spark, rows)).collect() if not r.verified} == touched
