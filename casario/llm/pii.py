"""Personal data: fixed patterns, and a semi-Markov conditional random field over spans.

The fixed patterns (email, ip, card, phone) always count.  The random field scores whole
candidate spans: features see the span as one piece (its shape, digit count, checksum, what
touches it), so a span can be found although no pattern of its surface form was written
down.  Candidates of at most `MAX_ATOMS` atoms are generated around digits and at-signs;
dynamic programming then chooses the best cut of each such island into spans and single
outside atoms, with boundaries and types decided together.  Text outside the islands has no
candidate and needs no dynamic programming.

Weights are trained here, by gradient ascent on the exact conditional likelihood (forward
and backward sums over all cuts), from a bounded sample: the islands of `TRAIN_DOCS`
documents with the patterns' spans as labels, rewritten in other surface forms, plus plain
numbers (dates, prices, versions, times) as counterexamples.

A null text is an empty one, without spans.  Found spans that touch a pattern's span are dropped; the
pattern's stays.  Of cuts with equal scores the one with fewer spans is taken.  Texts are read whole,
however long; repeated rows get equal findings; an empty table, or one without a number to learn
from, has the patterns only.  Other columns than `doc_id` and `text` may have any name.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.llm.common import findings, struct_udf

KINDS = ("email", "ip", "card", "phone")
#: Documents of the training sample.
TRAIN_DOCS = 400
MAX_ATOMS = 20
MAX_CHARS = 80
#: Characters of context on each side of an island.
CONTEXT = 24

SCHEMA = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
)

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_TRIGGER = re.compile(r"[0-9][^A-Za-z\n]{0,14}[0-9]|@|[\[({]at[\])}]", re.IGNORECASE | re.ASCII)
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.DOTALL)
_SPACE = re.compile(r"\s")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at-sign outwards, so that a long run of letters costs linear time."""
    begin, at = 0, text.find("@")
    while at >= 0:
        head = text[begin:at]
        start = begin + len(head.rstrip(_LOCAL))
        begin = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            begin = domain.end()
        at = text.find("@", begin)


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed and then by start."""
    found = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NOT_DIGIT.sub("", m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and at-signs, with context; they do not overlap."""
    start = end = -1
    for m in _TRIGGER.finditer(text):
        if start >= 0 and m.start() - CONTEXT <= end + CONTEXT:
            end = m.end()
            continue
        if start >= 0:
            yield max(0, start - CONTEXT), min(len(text), end + CONTEXT)
        start, end = m.span()
    if start >= 0:
        yield max(0, start - CONTEXT), min(len(text), end + CONTEXT)


def shape(span: str) -> str:
    """Letters to a, digits to d, runs to one."""
    out = []
    for c in span:
        k = "d" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:24])


def features(text: str, start: int, end: int) -> list[str]:
    """Features of the whole span text[start:end]; they do not depend on its type."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    n = len(digits)
    form = shape(span)
    out = [
        "bias",
        "shape=" + form,
        "frame=" + re.sub("[ad]+", "w", form),
        "digits=" + ("0" if n == 0 else "-6" if n < 7 else "-8" if n < 9 else "-12" if n < 13 else "-19" if n < 20 else "20-"),
        "pure" if not re.search("[A-Za-z]", span) else "mixed",
        "left=" + ("word" if start and text[start - 1].isalnum() else "joint" if start and text[start - 1] in "+-._@/:" else "edge"),
        "right=" + ("word" if end < len(text) and text[end].isalnum() else "joint" if text[end : end + 2].strip()[1:] else "edge"),
        "begins=" + (form[0] if form else ""),
        "dots=" + str(min(4, span.count("."))),
    ]
    if 13 <= n <= 19:
        out.append("luhn" if luhn(digits) else "no-luhn")
    if span.count("@") == 1 or re.search(r"[\[({]at[\])}]", span, re.IGNORECASE):
        host = re.split(r"@|[\[({]at[\])}]", span, maxsplit=1, flags=re.IGNORECASE)[1]
        out.append("host" if re.fullmatch(r"[\s.]*[A-Za-z0-9-]+(?:(?:\.| ?[\[({]dot[\])}] ?)[A-Za-z0-9-]+)+", host, re.IGNORECASE) else "no-host")
    parts = span.split(".")
    if len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts):
        out.append("octets" if all(map(octet, parts)) else "no-octets")
    if form.startswith(("+", "(")):
        out.append("dialled")
    return out


def cut(text: str, start: int, end: int) -> tuple[list[int], list[str]]:
    """Borders and texts of the atoms of a stretch."""
    borders = [start, *(m.end() for m in _ATOM.finditer(text, start, end))]
    return borders, [text[a:b] for a, b in zip(borders, borders[1:])]


def spans_ending(borders: list[int], atoms: list[str], j: int) -> Iterator[int]:
    """First atoms of the candidate spans whose last atom is j - 1."""
    if not atoms[j - 1][0].isalnum():
        return
    digits, at = 0, False
    for i in range(j - 1, max(-1, j - 1 - MAX_ATOMS), -1):
        atom = atoms[i]
        length = borders[j] - borders[i]
        if "\n" in atom or length > MAX_CHARS:
            return
        digits += len(atom) if atom[0].isdigit() else 0
        at = at or atom == "@" or atom in ("at", "AT") and i > 0 and atoms[i - 1] in "[({"
        if (atom[0].isalnum() or atom in "+(") and (at and j > i + 2 or digits >= 7 or digits >= 4 and length >= 7):
            yield i


class Lattice:
    """Candidate spans of a training piece with their features."""

    def __init__(self, text: str, start: int, end: int):
        self.borders, atoms = cut(text, start, end)
        self.ends = [[]] + [
            [(i, features(text, self.borders[i], self.borders[j])) for i in spans_ending(self.borders, atoms, j)]
            for j in range(1, len(self.borders))
        ]

    def scores(self, weights: dict[str, float]) -> list[list[tuple[int, str, float]]]:
        return [
            [(i, kind, sum(weights.get(f"{kind} {f}", 0.0) for f in feats)) for i, feats in found for kind in KINDS]
            for found in self.ends
        ]

    def gradient(self, weights: dict[str, float], gold: set[tuple[str, int, int]]) -> dict[str, float]:
        """Observed minus expected feature counts."""
        scored = self.scores(weights)
        n = len(self.borders)
        ahead, behind = [0.0] + [-math.inf] * (n - 1), [-math.inf] * (n - 1) + [0.0]
        plus = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b)
        for j in range(1, n):
            ahead[j] = ahead[j - 1]
            for i, _, s in scored[j]:
                ahead[j] = plus(ahead[j], ahead[i] + s)
        for j in range(n - 1, 0, -1):
            behind[j - 1] = plus(behind[j - 1], behind[j])
            for i, _, s in scored[j]:
                behind[i] = plus(behind[i], behind[j] + s)
        out: dict[str, float] = defaultdict(float)
        for j in range(1, n):
            feats = dict(self.ends[j])
            for i, kind, s in scored[j]:
                g = ((kind, self.borders[i], self.borders[j]) in gold) - math.exp(ahead[i] + s + behind[j] - ahead[-1])
                if abs(g) > 1e-4:
                    for f in feats[i]:
                        out[f"{kind} {f}"] += g
        return out


def decode(text: str, start: int, end: int, weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """The best cut of a stretch into typed spans and outside atoms (which score 0).

    Keeps two numbers an atom, whatever the length of the stretch."""
    borders, atoms = cut(text, start, end)
    best, back = [0.0], [None]
    for j in range(1, len(borders)):
        score, step = best[j - 1], None
        for i in spans_ending(borders, atoms, j):
            found = features(text, borders[i], borders[j])
            for kind in KINDS:
                s = best[i] + sum(weights.get(f"{kind} {f}", 0.0) for f in found)
                if s > score:
                    score, step = s, (i, kind)
        best.append(score)
        back.append(step)
    out, j = [], len(best) - 1
    while j > 0:
        if back[j]:
            i, kind = back[j]
            out.append((kind, borders[i], borders[j]))
            j = i
        else:
            j -= 1
    return out[::-1]


def _rewritten(kind: str, span: str, dice: random.Random) -> str:
    """The same datum in another surface form."""
    if kind == "email":
        return dice.choice((span, span, span.replace("@", " [at] "), span.replace("@", "(at)"), " [at] ".join((span.split("@")[0], span.split("@")[1].replace(".", " [dot] ")))))
    digits = _NOT_DIGIT.sub("", span)
    if kind == "phone" and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return dice.choice((span, span, f"({a}) {b}-{c}", f"+{digits[:-10] or 1} {a} {b} {c}", f"+{digits[:-10] or 1}-{a}-{b}-{c}"))
    if kind == "card" and len(digits) == 16:
        return dice.choice((span, span, ".".join(digits[k : k + 4] for k in range(0, 16, 4)), "-".join(digits[k : k + 4] for k in range(0, 16, 4))))
    return span


def _plain_number(dice: random.Random) -> str:
    n = dice.randrange
    return dice.choice((
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}", f"{n(1, 999)},{n(1000):03}.{n(100):02}",
        f"{n(1, 9)}.{n(20)}.{n(20)}", f"{n(24)}:{n(60):02}:{n(60):02}", f"{n(10**6, 10**9)}", f"{n(10**12, 10**17)}", f"{n(1, 99)} ({n(1900, 2100)}) {n(100, 999)}-{n(100, 999)}",
        f"{n(256, 999)}.{n(256, 999)}.{n(999)}.{n(999)}", f"v{n(9)}.{n(9)}.{n(9)}.{n(999, 9999)}", f"{n(16**20):020x}", f"{n(1000, 9999)} {n(1000, 9999)}", f"{n(1, 300)}/{n(1000000, 9999999)}",
    ))


def train(texts: list[str], rounds: int = 10, seed: int = 7) -> dict[str, float]:
    """Weights from labelled texts (the patterns are the labels) and counterexamples."""
    dice = random.Random(seed)
    examples = []
    for text in texts:
        for start, end in islands(text):
            piece = text[start:end]
            found = sorted(pattern_spans(piece), key=lambda x: (x[1], x[1] - x[2]))
            fresh, gold, plain, done = "", set(), "", 0
            for kind, a, b in found:
                if a >= done:
                    other = _rewritten(kind, piece[a:b], dice)
                    fresh += piece[done:a]
                    gold.add((kind, len(fresh), len(fresh) + len(other)))
                    fresh += other
                    plain += piece[done:a] + _plain_number(dice)
                    done = b
            examples.append((fresh + piece[done:], gold))
            if gold and not pattern_spans(plain + piece[done:]):
                examples.append((plain + piece[done:], set()))
    dice.shuffle(examples)
    lattices = [(Lattice(piece, 0, len(piece)), gold) for piece, gold in examples[: 2 * TRAIN_DOCS]]
    weights: dict[str, float] = defaultdict(float)
    squares: dict[str, float] = defaultdict(float)
    for _ in range(rounds):
        for lattice, gold in lattices:
            for f, g in lattice.gradient(weights, gold).items():
                squares[f] += g * g
                weights[f] += 0.5 * g / math.sqrt(1e-6 + squares[f])
        for f in weights:
            weights[f] *= 0.98
    return dict(weights)


def training_sample(docs: DataFrame, text: str = "text") -> list[str]:
    """Islands' documents for training: the TRAIN_DOCS smallest hashes among those with a candidate."""
    number = r"(?:[0-9][^A-Za-z\n]{3,}[0-9]|@)"
    piece = F.substring(F.regexp_extract(text, r"[^\n]{0,80}" + number + r"[^\n]{0,80}", 0), 1, 400)
    rows = (
        docs.filter(F.col(text).rlike(number))
        .select(F.xxhash64(text).alias("h"), piece.alias("piece"))
        .orderBy("h", "piece")
        .limit(TRAIN_DOCS)
        .collect()  # at most TRAIN_DOCS short pieces
    )
    return [r.piece for r in rows]


def tell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scanner(weights: dict[str, float]):
    place = {kind: k for k, kind in enumerate(KINDS)}

    def scan(texts: list[str | None]) -> Iterator[tuple]:
        for text in texts:
            base = pattern_spans(text) if text else []
            spans = list(base)
            if text and weights:
                taken = bytearray(len(text))
                for _, a, b in base:
                    taken[a:b] = b"\1" * (b - a)
                for start, end in islands(text):
                    spans += [s for s in decode(text, start, end, weights) if not any(taken[s[1] : s[2]])]
                spans.sort(key=lambda x: (place[x[0]], x[1]))
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            yield (*counts, hashlib.sha256(tell(base).encode()).hexdigest(), tell(spans), len(spans))

    return scan


def personal_data(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """A row per document: counts of the fixed patterns, their digest, and all spans.

    Offsets count code points, ends are exclusive.  Without weights they are trained first.
    """
    weights = train(training_sample(docs)) if weights is None else weights
    return findings(docs, struct_udf(scanner(weights), SCHEMA)(F.col("text")))


def masked(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The documents with every span of `text` replaced by its kind in angle brackets."""

    @F.pandas_udf("string")
    def mask(texts):
        scan = scanner(weights)

        def one(text, spans):
            if not text or not spans:
                return text
            out, end = [], 0
            for k, a, b in sorted((s.split(":") for s in spans.split(",")), key=lambda s: int(s[1])):
                if int(a) >= end:
                    out += [text[end : int(a)], f"<{k}>"]
                    end = int(b)
                elif int(b) > end:
                    end = int(b)
            return "".join([*out, text[end:]])

        values = list(texts)
        return texts.__class__([one(t, r[5]) for t, r in zip(values, scan(values))])

    return docs.withColumn("text", mask("text"))
