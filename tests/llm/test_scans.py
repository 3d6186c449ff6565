"""Per-document scans against brute force: personal data, secrets, licences, quality rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from casario.llm import credentials, licenses, pii, quality
from llm.samples import awkward, clashing, edited, frame, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def pii_brute(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if fits():
                out.append((kind, *m.span()))
    return out


def secrets_brute(text):
    least = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(SECRETS.items()) for m in p.finditer(text) if least[kind](m)]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


@pytest.mark.parametrize("seed", range(4))
def test_pii_patterns(seed):
    dice = random.Random(seed)
    for _ in range(8000):
        text = "".join(dice.choice("a.@+-1239 ()5") for _ in range(dice.randrange(40)))
        assert pii.pattern_spans(text) == pii_brute(text), text


@pytest.mark.parametrize("seed", range(4))
def test_secret_patterns(seed):
    dice = random.Random(seed)
    parts = ["token", "PASSWORD", "api_key", "=", ": ", '"', "abc", "AKIA", "AKIA" + "Q" * 16, "deadbeef" * 3, "ſecret", " ", "12", "\n"]
    for _ in range(4000):
        text = "".join(dice.choice(parts) for _ in range(dice.randrange(12)))
        assert credentials.pattern_spans(text) == secrets_brute(text), text


def test_semi_markov_field_splits_what_patterns_merge():
    dice = random.Random(3)
    def card():
        head = "4" + "".join(str(dice.randrange(10)) for _ in range(14))
        return next(head + str(k) for k in range(10) if pii.luhn(head + str(k)))
    texts = []
    for k in range(240):
        a, b = (" ".join("abcdefgh"[int(c) % 8] * 3 for c in words(x, 8)[1:20] if c.isdigit()) for x in (k, k + 999))
        datum = [f"{k}x@mail.example.com", f"{k}.20.30.40", card(), f"+1 ({200 + k}) 555-{1000 + 7 * k}"][k % 4]
        texts.append(f"{a} {datum} {b}")
    weights = pii.train(texts)
    number = card()
    text = f"call +1 (269) 555-3296 {number} now"
    assert not pii.pattern_spans(text)
    found = next(pii.scanner(weights)([text]))[5]
    assert found == f"card:{23}:{39},phone:5:22"
    plain = "on 2024-01-05 at 12:30:11 we paid 1,234,567.89 for version 3.11.2"
    assert next(pii.scanner(weights)([plain]))[5] == ""


def test_masking(spark):
    docs = frame(spark, [(1, "write to joe@example.com today", "en", "s", 1), (2, None, None, None, None), (3, "", "", "", 0)])
    got = {r.doc_id: r.text for r in pii.masked(docs, {}).collect()}
    assert got == {1: "write to <email> today", 2: None, 3: ""}


def test_weak_parts_need_each_other():
    def spans(text):
        return next(credentials.scan([text]))[4]

    ident, key, host = "QZ7AB12CD34EF56GH78", "wJalrXUtnFEMIK7MDENGbPxRfiCYz0aB3kQ", "db.example.com:5432"
    assert spans(f"{ident} alone") == spans(f"{key} alone") == spans(f"{host} alone") == spans(f"{ident} {host}") == ""
    assert [s.split(":")[0] for s in spans(f"{ident} {key}").split(",")] == ["id", "key"]
    assert [s.split(":")[0] for s in spans(f"{host} {key}").split(",")] == ["key"]
    assert [s.split(":")[0] for s in spans(f"{host} {key} {ident}").split(",")] == ["endpoint", "key", "id"]
    assert spans(f"{ident}\n\n{key}") == "" and spans(ident + " x" * 200 + key) == ""
    assert spans(f"password = hunter22 {ident}").startswith("assign:0:19,id:")


def test_expressions():
    assert licenses.evaluate("MIT OR GPL-2.0") == ({"mit", "gpl-2.0"}, 0.9)
    assert licenses.evaluate("(MIT OR GPL-2.0) AND CC-BY-NC-4.0")[1] == 0.2
    assert licenses.evaluate("MIT AND GPL-2.0 OR CC0-1.0")[1] == 1.0
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception-2.0") == ({"gpl-2.0"}, 0.7)
    assert licenses.evaluate("(MIT OR")[0] == {"mit"} and licenses.evaluate("()") == (set(), None)
    assert licenses.evaluate("") == (set(), None) and licenses.evaluate("OR AND ) (")[1] is None


def licenses_brute(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    base = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        base += [(k, label) for k in range(len(found) - len(p) + 1) if found[k : k + len(p)] == p]
    starts = [k for k, _ in base]
    return len(found), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base}))


def quality_brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(found)
    seen = Counter(tuple(found[k : k + 8]) for k in range(n - 7))
    inside = {j for k in range(n - 7) if seen[tuple(found[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = text.split("\n")
    dup = sum(1 for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in set(lines[:k]))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, found)), symbols, dup, len(inside), n < 20 or 100 * len(inside) > 30 * n


@pytest.fixture(scope="module")
def rows():
    dice, more = random.Random(5), []
    for k in range(60):
        a = words(200 + k, dice.randrange(1, 90), dice.choice([2, 5, 400]))
        more.append((200 + k, a + dice.choice(["", "\n" + a, " the MIT License\nCC-BY 4.0", "\nGNU General Public License & $ |"]), "en", "s", 1))
    return awkward() + more


def test_scans_on_awkward_rows(spark, rows):
    docs = clashing(frame(spark, rows))
    got = {
        "pii": pii.personal_data(docs, {}).collect(),
        "secrets": credentials.secrets(docs).collect(),
        "licenses": licenses.licenses(docs).collect(),
        "quality": quality.quality_report(docs).collect(),
    }
    digest = lambda spans: hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    want = {"pii": Counter(), "secrets": Counter(), "licenses": Counter(), "quality": Counter()}
    for doc_id, text, *_ in rows:
        if text is None or len(text) < 100_000:  # the plain patterns take quadratic time
            base = pii_brute(text or "")
            want["pii"][(doc_id, *(sum(k == kind for k, _, _ in base) for kind in PII), digest(base))] += 1
        want["secrets"][(doc_id, digest(secrets_brute(text or "")))] += 1
        want["licenses"][(doc_id, *licenses_brute(text))] += 1
        want["quality"][(doc_id, *quality_brute(text))] += 1
    long_ids = {r[0] for r in rows if r[1] and len(r[1]) >= 100_000}
    assert Counter(tuple(r)[:6] for r in got["pii"] if r.doc_id not in long_ids) == want["pii"]
    assert Counter((r.doc_id, r.base_sha256) for r in got["secrets"]) == want["secrets"]
    assert Counter(tuple(r)[:6] for r in got["licenses"]) == want["licenses"]
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got["quality"]) == want["quality"]
    assert all(r.base_labels in r.labels or not r.base_labels for r in got["licenses"])
    assert all(0 <= r.score <= 1 for r in got["licenses"])
    assert not any(r.kept and r.base_failed for r in got["quality"])


def test_scans_on_no_rows(spark):
    docs = frame(spark, [])
    for found in (pii.personal_data(docs), credentials.secrets(docs), licenses.licenses(docs), quality.quality_report(docs), quality.keep_good(docs)):
        assert found.count() == 0


def longest_repeat(ids):
    best = 0
    for a in range(len(ids)):
        for b in range(a):
            k = 0
            while a + k < len(ids) and ids[a + k] == ids[b + k]:
                k += 1
            best = max(best, k)
    return best


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array_repeats(seed):
    import numpy as np

    dice = random.Random(seed)
    ids = [dice.randrange(dice.choice([1, 2, 3, 9])) for _ in range(dice.randrange(1, 60))]
    for least in (2, 4, 8):
        spans, longest, _ = quality.repeated_spans(np.array(ids), least)
        seen = Counter(tuple(ids[k : k + least]) for k in range(len(ids) - least + 1))
        inside = {j for k in range(len(ids) - least + 1) if seen[tuple(ids[k : k + least])] > 1 for j in range(k, k + least)}
        assert set(np.nonzero(spans)[0].tolist()) == inside
        assert longest == longest_repeat(ids)


def test_quality_keeps_clean_and_drops_repetitive(spark):
    clean, passage = words(1, 200, 5000), words(2, 60, 5000)
    rows = [(1, clean, "", "", 1), (2, f"{passage} {words(3, 100, 5000)} {passage}", "", "", 1), (3, edited(clean, 1, 9), "", "", 1)]
    assert {r.doc_id for r in quality.keep_good(frame(spark, rows)).collect()} == {1, 3}


def test_quality_method_decides_where_the_base_rule_does_not(spark):
    passage, longer, short = words(2, 24, 5000), words(4, 30, 5000), words(6, 10, 5000)
    rows = [
        (1, f"{passage} {words(3, 152, 5000)} {passage}", "", "", 1),  # 24 % of the words repeat
        (2, f"{longer} {words(5, 204, 5000)} {longer}", "", "", 1),  # a repeat of 30 of 264 words
        (3, f"{short} {words(7, 180, 5000)} {short}", "", "", 1),  # 10 % repeat, in short repeats
    ]
    got = {r.doc_id: r for r in quality.quality_report(frame(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {k: r.kept for k, r in got.items()} == {1: False, 2: False, 3: True}
    assert {r.doc_id for r in quality.keep_good(frame(spark, rows)).collect()} == {3}


def licence_brute(tokens):
    """Labels and freedom by recursive descent: or below and below with, each from the left."""
    at = 0

    def level(operators, below):
        nonlocal at
        labels, value = below()
        while at < len(tokens) and tokens[at] in operators:
            operator, at = tokens[at], at + 1
            more, other = below()
            if operator == "with":
                labels, value = labels - more | labels, (value + 1) / 2
            else:
                labels, value = labels | more, max(value, other) if operator == "or" else min(value, other)
        return labels, value

    def one():
        nonlocal at
        token, at = tokens[at], at + 1
        if token != "(":
            return {token}, licenses.freedom(token)
        inner, at = level({"or"}, lambda: level({"and"}, lambda: level({"with"}, one))), at + 1
        return inner

    return level({"or"}, lambda: level({"and"}, lambda: level({"with"}, one)))


@pytest.mark.parametrize("seed", range(60))
def test_expressions_against_recursive_descent(seed):
    dice = random.Random(seed)
    names = ["mit", "gpl-2.0", "agpl-3.0", "apache-2.0", "x-1", "cc0-1.0", "bsd-3-clause"]

    def made(depth):
        if depth == 0 or dice.random() < 0.3:
            name = [dice.choice(names)]
            return [*name, "with", f"exception-{dice.randrange(9)}"] if dice.random() < 0.2 else name
        left, right = made(depth - 1), made(depth - 1)
        whole = [*left, dice.choice(["or", "and"]), *right]
        return ["(", *whole, ")"] if dice.random() < 0.5 else whole

    tokens = made(4)
    labels, value = licenses.evaluate(" ".join(tokens).replace("( ", "(").replace(" )", ")").upper())
    want, freedom = licence_brute(tokens)
    assert labels == {x for x in want if not x.startswith("exception-")} and value == pytest.approx(freedom)


@pytest.mark.parametrize(
    "line, labels, score",
    [
        ("GPL-2.0 or later version of it", {"gpl-2.0"}, 0.4),
        ("MIT and see the notice", {"mit"}, 0.9),
        ("(AGPL-3.0 OR", {"agpl-3.0"}, 0.3),
        ("see the file COPYING", set(), None),
        ("LicenseRef-own AND MIT with thanks", {"licenseref-own", "mit"}, 0.3),
        ("MIT OR", {"mit"}, 0.9),
    ],
)
def test_prose_after_a_tag_is_no_label(line, labels, score):
    assert licenses.evaluate(line) == (labels, score)


@pytest.mark.parametrize("seed", range(40))
def test_linking_against_all_pairs(seed):
    dice = random.Random(seed)
    pieces = ["AB12CD34EF56GH78", "aB3dE5fG7hJ9kL1mN2pQ4rS6t", "https://api.example.org/v1", "password=hunter2secret", "0123456789abcdef" * 2]
    text = ""
    for _ in range(dice.randrange(2, 14)):
        text += dice.choice(pieces) + dice.choice([" ", "\n", "\n\n", " " + "x y " * dice.randrange(90), " " + "0a" * dice.randrange(12, 300) + " "])
    base = credentials.pattern_spans(text)
    taken = {p for _, a, b in base for p in range(a, b)}
    weak = [s for s in credentials.weak_spans(text) if not taken & set(range(s[1], s[2]))]
    ends = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    paragraph = lambda a: sum(e < a for e in ends)

    def near(role, a, b):
        return any(
            credentials.ROLE[k] == role and (x, y) != (a, b) and x < b + credentials.REACH and y > a - credentials.REACH and paragraph(x) == paragraph(a)
            for k, x, y in base + weak
        )

    want = []
    for k, a, b in weak:
        id_, key, end = (near(role, a, b) for role in ("identifier", "secret", "endpoint"))
        if {"id": key, "key": id_ or end, "endpoint": id_ and key}[k]:
            want.append((k, a, b))
    assert credentials.linked(text, base) == want


def test_linking_many_parts_is_fast():
    import time

    text = "\n\n" + "0a" * 200_000 + "\n\n" + " ".join(f"AB12CD34EF56{k:04d}" for k in range(4000))
    start = time.perf_counter()
    assert credentials.linked(text, credentials.pattern_spans(text)) == []
    assert time.perf_counter() - start < 2


def all_cuts(text):
    """Every way to cut a stretch into typed spans and outside atoms, as a list of (kind, first, last border)."""
    borders, atoms = pii.cut(text, 0, len(text))

    def upto(j):
        if j == 0:
            return [[]]
        out = list(upto(j - 1))
        for i in pii.spans_ending(borders, atoms, j):
            out += [[*rest, (kind, borders[i], borders[j])] for rest in upto(i) for kind in pii.KINDS]
        return out

    return upto(len(borders) - 1)


PIECES = ["call 555-0101 now", "a.b@c.de or x", "10.0.0.1 22 3333", "+1 555 010 2345", "no 4111 1111", "at [at] b 12"]


@pytest.mark.parametrize("text", PIECES)
@pytest.mark.parametrize("seed", range(3))
def test_field_against_all_cuts(text, seed):
    dice = random.Random(f"{seed}{text}")
    cuts = all_cuts(text)
    assert len(cuts) > 1 or "[at]" in text
    names = sorted({f"{kind} {f}" for found in cuts for kind, a, b in found for f in pii.features(text, a, b)})
    weights = {name: dice.uniform(-2, 2) for name in names}
    counts = [Counter(f"{kind} {f}" for kind, a, b in found for f in pii.features(text, a, b)) for found in cuts]
    scores = [sum(weights[f] * n for f, n in c.items()) for c in counts]
    # The best cut (scores are distinct but for those without a span).
    assert pii.decode(text, 0, len(text), weights) == cuts[max(range(len(cuts)), key=scores.__getitem__)]
    # Observed counts of some cut less the expected ones.
    total = sum(math.exp(s) for s in scores)
    gold = set(dice.choice(cuts))
    got = pii.Lattice(text, 0, len(text)).gradient(weights, gold)
    for name in names:
        observed = Counter(f"{kind} {f}" for kind, a, b in gold for f in pii.features(text, a, b))[name]
        expected = sum(c[name] * math.exp(s) for c, s in zip(counts, scores)) / total
        assert got.get(name, 0.0) == pytest.approx(observed - expected, abs=2e-3)


def test_trained_field_on_awkward_rows(spark):
    rows = awkward() + [(900 + k, f"mail a{k}@host{k}.org or call +1 (555) 010-{k:04}, card 4111 1111 1111 1111", "en", "s", 1) for k in range(60)]
    got = pii.personal_data(clashing(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    plain = {r.doc_id: r for r in got}
    for k in range(60):
        spans = plain[900 + k].spans.split(",")
        assert any(s.startswith("email:") for s in spans) and any(s.startswith("card:") for s in spans)
    for r in got:
        ends = {}
        for kind, a, b in (s.rsplit(":", 2) for s in r.spans.split(",") if s):
            assert ends.get(kind, 0) <= int(a) < int(b)
            ends[kind] = int(b)
