"""Secrets: fixed patterns, and linking of the parts that make up one credential.

The fixed patterns (assign, access, hex) always count.  Besides, a text has weak candidates
that mean nothing alone: upper-case identifiers, token-like strings of mixed characters,
and endpoints.  The parts of a text are intervals, widened by `REACH` code points to their
scope and cut at blank lines; an interval join (a sweep over sorted starts) tells which
complementary parts share a scope.  A weak identifier is reported only with a secret, a
weak secret only with an identifier or an endpoint, and an endpoint only with both.

A null text is an empty one, without spans.  Weak spans that touch a pattern's span are dropped, and
no part confirms one of the same span.  Texts are read whole, in a time that grows with their length
and the logarithm of their parts; repeated rows get equal findings; an empty table gives no rows.
Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casario.llm.common import findings, struct_udf

KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
#: Code points on each side that belong to the scope of a part.
REACH = 240
#: A weak secret has this many bits a character at least, measured on itself.
MIN_ENTROPY = 3.5
#: What each kind stands for in a credential.
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "id": "identifier", "key": "secret", "endpoint": "endpoint"}

SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"
)

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_WORDS = re.compile("passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")
_ID = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,32}(?![A-Za-z0-9])")
_KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,128}={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"https?://[^\s\"'<>]{4,200}|(?<![\w.@-])(?:[a-z0-9-]{1,63}\.){1,8}[a-z]{2,10}:[0-9]{2,5}(?![0-9])")
_SCOPE_END = re.compile(r"\n[ \t\r]*\n")


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start and then by kind as listed."""
    found = []
    if _WORDS.search(text):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def entropy(token: str) -> float:
    return -sum(c / len(token) * math.log2(c / len(token)) for c in Counter(token).values())


def weak_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("id", *m.span()) for m in _ID.finditer(text)]
    for m in _KEY.finditer(text):
        token = m[0]
        classes = bool(re.search("[a-z]", token)) + bool(re.search("[A-Z]", token)) + bool(re.search("[0-9]", token))
        if classes == 3 and entropy(token) >= MIN_ENTROPY:
            found.append(("key", *m.span()))
    if ":" in text:
        found += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    return found


class Parts:
    """The intervals of one role by paragraph, sorted by start, with the two largest ends so far."""

    def __init__(self, spans: set[tuple[int, int, int]]):
        self.starts, self.ends = {}, {}
        for paragraph, a, b in sorted(spans):
            starts, ends = self.starts.setdefault(paragraph, []), self.ends.setdefault(paragraph, [])
            before = ends[-1] if ends else []
            starts.append(a)
            ends.append(sorted([*before, (b, a)], reverse=True)[:2])

    def touch(self, paragraph: int, a: int, b: int) -> bool:
        """Does a part other than [a, b) overlap its scope, in the same paragraph?"""
        k = bisect_left(self.starts.get(paragraph, []), b + REACH)
        return k > 0 and any(y > a - REACH and (x, y) != (a, b) for y, x in self.ends[paragraph][k - 1])


def linked(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The weak spans that complementary parts in their scope confirm."""
    taken = bytearray(len(text) if base else 0)
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)
    weak = [s for s in weak_spans(text) if not any(taken[s[1] : s[2]])]
    if not weak:
        return []
    borders = [m.start() for m in _SCOPE_END.finditer(text)]
    parts = {role: Parts({(bisect_left(borders, a), a, b) for k, a, b in base + weak if ROLE[k] == role}) for role in set(ROLE.values())}

    def near(role: str, a: int, b: int) -> bool:
        return parts[role].touch(bisect_left(borders, a), a, b)

    needs = {
        "id": lambda a, b: near("secret", a, b),
        "key": lambda a, b: near("identifier", a, b) or near("endpoint", a, b),
        "endpoint": lambda a, b: near("identifier", a, b) and near("secret", a, b),
    }
    return [(k, a, b) for k, a, b in weak if needs[k](a, b)]


def tell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(texts: list[str | None]) -> Iterator[tuple]:
    for text in texts:
        base = pattern_spans(text) if text else []
        more = linked(text, base) if text else []
        counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
        yield (*counts, hashlib.sha256(tell(base).encode()).hexdigest(), tell(in_order(base + more)), len(more))


def secrets(docs: DataFrame) -> DataFrame:
    """A row per document: counts of the fixed patterns, their digest, and all spans."""
    return findings(docs, struct_udf(scan, SCHEMA)(F.col("text")))
