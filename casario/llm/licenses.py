"""Licences: an Aho-Corasick automaton finds notice phrases and identifier tags; the licence
expression after a tag is read by a shunting-yard parser and evaluated.

Phrases are matched on whole words, so the automaton runs over the words joined by single
spaces.  `labels` has the labels of the four base phrases, of the longer notice phrases, and
the identifiers of tagged expressions.  `score` says how freely the text may be used: a
label has a freedom between 0 and 1, `or` takes the larger, `and` the smaller, `with` (an
exception) moves its licence half way to 1; of several statements the strictest counts, and
a text without any has 0.

An expression ends before what is no identifier: one is listed here, or has a digit or a dash, so
that prose after a tag adds no label.  One that does not parse counts as the listed labels in it.

A null text is an empty one, without labels.  Texts are read whole, however long; phrases that
overlap all count; repeated rows are judged alike; an empty table gives no rows.  Only `doc_id` and
`text` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casario.llm.common import alnum_words, findings, struct_udf

# The base phrases, the phrases of the method, and the freedom of labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu lgpl": "lgpl",
    "gnu agpl": "agpl",
    "gnu gpl": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
    "creative commons attribution": "cc-by",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "licensed under the apache license": "apache",
    "licensed under the mit license": "mit",
    "released into the public domain": "unlicense",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "isc license": "isc",
    "creative commons zero": "cc0",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute": "isc",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
FREEDOM = {
    "proprietary": 0.0, "cc-by-nd": 0.1, "cc-by-nc": 0.2, "agpl": 0.3, "gpl": 0.4, "cc-by-sa": 0.5, "lgpl": 0.6, "epl": 0.6,
    "mpl": 0.7, "cc-by": 0.8, "apache": 0.9, "bsd": 0.9, "mit": 0.9, "isc": 0.9, "cc0": 1.0, "unlicense": 1.0,
}
#: Freedom of an identifier that is not listed.
UNKNOWN = 0.3

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def listed(label: str) -> str | None:
    """The longest listed label that the identifier begins with."""
    name = label.lower().rstrip("+")
    return max((k for k in FREEDOM if name == k or name.startswith(k + "-")), key=len, default=None)


def freedom(label: str) -> float:
    known = listed(label)
    return UNKNOWN if known is None else FREEDOM[known]


def is_identifier(token: str) -> bool:
    return token.lower() not in _PRECEDENCE and bool(listed(token) or re.search("[A-Za-z]", token) and re.search("[0-9-]", token.strip("-.")))


def postfix(expression: str) -> list[str] | None:
    """Shunting yard: identifiers and operators in evaluation order; None if malformed."""
    out, held, operand = [], [], False
    tokens = _TOKEN.findall(expression)
    for token, following in zip(tokens, [*tokens[1:], ""]):
        low = token.lower()
        if low in _PRECEDENCE:
            if not operand:
                return None
            if following != "(" and not is_identifier(following):
                break  # prose that begins with one of these words
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= _PRECEDENCE[low]:
                out.append(held.pop())
            held.append(low)
            operand = False
        elif token == "(":
            if operand:
                return None
            held.append(token)
        elif token == ")":
            if not operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if operand:
                break  # prose after the expression
            if not is_identifier(token):
                return None
            out.append(low)
            operand = True
    if not operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(expression: str) -> tuple[set[str], float | None]:
    """Licence identifiers of an expression and its freedom."""
    steps = postfix(expression)
    if steps is None:
        ids = {t.lower() for t in _TOKEN.findall(expression) if listed(t)}
        return ids, min(map(freedom, ids), default=None)
    labels, stack = set(), []
    for step in steps:
        if step in _PRECEDENCE:
            (b, right), (a, left) = stack.pop(), stack.pop()
            if step == "with":
                stack.append((a + "|with", (left + 1) / 2))
                labels.discard(b)
            else:
                stack.append(("", max(left, right) if step == "or" else min(left, right)))
        else:
            labels.add(step)
            stack.append((step, freedom(step)))
    return labels, stack[0][1]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {**PHRASES, **BASE, TAG: ""}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(texts: list[bytes | None]) -> Iterator[tuple]:
    search = automaton()
    for text in texts:
        words = alnum_words(text)
        line = f" {b' '.join(words).decode()} "
        base, labels, scores, starts, tags = [], set(), [], None, 0
        for end, phrase in search.iter(line):
            if starts is None:
                starts = [0]
                for w in words:
                    starts.append(starts[-1] + 1 + len(w.decode()))
            word = bisect_right(starts, end - len(phrase) - 1) - 1
            if phrase in BASE:
                base.append((word, BASE[phrase]))
            if phrase == TAG:
                tags += 1
            else:
                label = BASE.get(phrase) or PHRASES[phrase]
                labels.add(label)
                scores.append(freedom(label))
        if tags:
            for m in re.finditer(r"spdx-license-identifier:([^\n]*)", text.decode(), re.IGNORECASE):
                ids, score = evaluate(m[1])
                labels |= ids
                scores += [] if score is None else [score]
        places = [w for w, _ in base]
        yield (
            len(words), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), min(scores, default=0.0),
        )


def licenses(docs: DataFrame) -> DataFrame:
    """A row per document: places of the base phrases (words from 0), labels, and score."""
    return findings(docs, struct_udf(scan, SCHEMA)(F.col("text").cast("binary")))
