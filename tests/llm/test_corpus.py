"""Operators on the corpus against brute force: decontamination, near-duplicates, scoring,
mixing, sharding, URL templates."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from casario.llm import common, decontamination, mixing, neardup, ppm, sharding, url_templates
from casario.llm import queries as registered
from casario.llm.common import alnum_words
from llm.samples import awkward, clashing, edited, frame, words
from pyspark.sql import functions as F


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, n int")


def leaks_brute(text, tests):
    found = alnum_words(text.encode()) if text else []
    hit, own = set(), set()
    for name, item in tests:
        w = alnum_words(item.encode()) if item else []
        m = min(10, len(w))
        windows = {tuple(w[k : k + m]) for k in range(len(w) - m + 1)} if w else set()
        for k in range(len(found) - m + 1):
            if tuple(found[k : k + m]) in windows:
                hit.update(range(k, k + m))
                own.add("" if name is None else str(name))
    return len(found), hit, own


@pytest.mark.parametrize("shard_bytes", [1 << 20, 600])
def test_decontamination(spark, shard_bytes):
    tests = [(1, words(1, 30), 0), (2, "w1 w2 w3", 0), (2, words(11, 14), 0), (3, None, 0), (4, "...", 0), (None, words(12, 12), 0), (5, words(1, 30), 0)]
    tests += [(10 + k, words(500 + k, 40), 0) for k in range(10)]
    rows = awkward() + [(300, "Intro, " + words(1, 30).upper() + "! w1-w2 w3", "", "", 1), (301, words(505, 25), "", "", 1)]
    docs = clashing(frame(spark, rows))
    found = decontamination.matches(docs, items(spark, tests), shard_bytes=shard_bytes).select("doc.doc_id", "doc.text", "match.*").collect()
    assert len(found) == len(rows)
    for r in found:
        if r.text and len(r.text) > 100_000:
            continue
        n, hit, own = leaks_brute(r.text, [t[:2] for t in tests])
        assert (r.n_words, {k for s in r.spans for k in range(s.start, s.stop)}, set(r["items"])) == (n, hit, own)
    dropped = decontamination.decontaminated(docs, items(spark, tests))
    assert dropped.columns == docs.columns and 300 not in {r.doc_id for r in dropped.collect()} and 100 in {r.doc_id for r in dropped.collect()}
    cut = decontamination.decontaminated(docs, items(spark, tests), 0, 1.0)
    assert cut.count() == len(rows) and not decontamination.contamination(cut.filter("length(text) < 100000"), items(spark, tests)).filter("contaminated").count()


def test_decontamination_without_items_or_documents(spark):
    none = items(spark, [])
    docs = frame(spark, awkward())
    assert decontamination.decontaminated(docs, none).count() == docs.count()
    assert decontamination.contamination(frame(spark, []), items(spark, [(1, words(1, 20), 0)])).count() == 0


def components_brute(rows):
    sets = []
    for doc_id, text, *_ in rows:
        w = text.encode().lower().split() if text else []
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * x >= 75 * (len(sets[a]) + len(sets[b]) - x):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            ids[root(k)].append(doc_id)
    out, first = [], {}
    for k, (doc_id, *_) in enumerate(rows):
        component = min(ids[root(k)], default=None) if sets[k] else doc_id
        # Of rows without an id one stays, and only where there is no other.
        own = root(k) if sets[k] else -1 - k
        kept = component == doc_id and (doc_id is not None or first.setdefault(own, k) == k)
        out.append((doc_id, len(sets[k]), component, kept))
    return Counter(out)


def test_near_duplicates(spark):
    rows, dice = awkward(), random.Random(2)
    for g in range(6):  # groups of edited copies, around a shared passage
        base = words(900 + g, dice.randrange(40, 150), 5000)
        rows += [(1000 + 100 * g + k, edited(base, k, dice.randrange(6)), "", "", 1) for k in range(25)]
    passage = words(77, 80, 5000)
    rows += [(3000 + k, f"{passage} {words(k, dice.randrange(5, 120), 5000)}", "", "", 1) for k in range(60)]
    rows += [(4000 + k, " ".join(f"z{j}" for j in range(k, k + 40)), "", "", 1) for k in range(30)]  # a chain
    dice.shuffle(rows)
    got = neardup.near_duplicates(clashing(frame(spark, rows))).collect()
    assert Counter(map(tuple, got)) == components_brute(rows)
    left = neardup.without_near_duplicates(clashing(frame(spark, rows)))
    kept = Counter(r[0] for r in components_brute(rows) if r[3])
    assert Counter(r.doc_id for r in left.filter("doc_id is not null").collect()) == Counter({k: 1 for k in kept if k is not None})
    assert neardup.near_duplicates(frame(spark, [])).count() == neardup.without_near_duplicates(frame(spark, [])).count() == 0


def test_near_duplicates_under_null_and_repeated_ids(spark):
    a, b, t = (words(k, 120, 5000) for k in (1, 2, 3))
    rows = [(1, a), (1, b), (2, edited(b, 1, 2)), (3, t), (None, edited(t, 1, 2)), (None, words(4, 80)), (None, words(4, 80)), (1, a), (9, ""), (None, None), (9, "")]
    rows = [(k, text, "en", "s", n) for n, (k, text) in enumerate(rows)]
    assert Counter(map(tuple, neardup.near_duplicates(frame(spark, rows)).collect())) == components_brute(rows)
    left = [(r.doc_id, r.text) for r in neardup.without_near_duplicates(clashing(frame(spark, rows))).collect()]
    want = [(1, a), (1, b), (3, t), (None, words(4, 80)), (9, ""), (None, None), (9, "")]
    assert Counter(left) == Counter(want)
    same = frame(spark, [(None, a, "", "", 1), (None, a, "", "", 1), (7, a, "", "", 1)])
    assert [r.doc_id for r in neardup.without_near_duplicates(same).collect()] == [7]


def test_near_duplicates_with_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_PARTS", 5)
    a, b = words(1, 120, 5000), words(2, 120, 5000)
    texts = [a] * 40 + [edited(a, k, 2) for k in range(20)] + [None] * 40 + [b, edited(b, 1, 1)]
    rows = [(k if k % 3 else None, text, "en", "s", k) for k, text in enumerate(texts)]
    assert Counter(map(tuple, neardup.near_duplicates(frame(spark, rows)).collect())) == components_brute(rows)


def test_ppm(spark, monkeypatch):
    monkeypatch.setattr(ppm, "HOT_WORDS", 20)
    rows = awkward() + [(k, words(k, 30, 50), "", "", 1) for k in range(500, 530)]
    got = ppm.scores(clashing(frame(spark, rows))).collect()
    counts, contexts = Counter(), [defaultdict(Counter) for _ in range(3)]
    tokens = lambda t: (t or "").encode().lower().split() + [b" "]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for doc_id, text, *_ in rows:
        if not held(doc_id):
            counts.update(tokens(text))
            x = b"\0\0" + (text or "").encode() + b"\0"
            for k in range(2, len(x)):
                for o in range(3):
                    contexts[o][x[k - o : k]][x[k]] += 1
    total, distinct = sum(counts.values()), len(counts)

    def price(history, b):
        out, rest = set(), 1.0
        for o in (2, 1, 0):
            seen = {s: n for s, n in contexts[o].get(history[2 - o :], {}).items() if s not in out}
            if seen:
                whole = sum(seen.values()) + (0 if len(seen) == 256 - len(out) else len(seen))
                if b in seen:
                    return rest * seen[b] / whole
                rest *= len(seen) / whole
                out |= set(seen)
        return rest / (256 - len(out))

    want = Counter((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    by_id = {i: t for i, t, *_ in rows if i is not None}
    for r in got:
        text = by_id.get(r.doc_id)
        if r.doc_id is None or text and len(text) > 50_000:
            continue
        base = sum(math.log10((counts[w] + 1) / (total + 1 * (distinct + 1))) for w in tokens(text))
        x = b"\0\0" + (text or "").encode() + b"\0"
        score = sum(math.log10(price(x[k - 2 : k], x[k])) for k in range(2, len(x)))
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-4)
    assert ppm.scores(frame(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [30, 10**6])
def test_ppm_of_longer_contexts(spark, monkeypatch, hot):
    """Order 5 against brute force, with few grams sent and with all of them."""
    monkeypatch.setattr(ppm, "HOT_GRAMS", hot)
    rows = [(k, words(k, 30, 50), "", "", 1) for k in range(500, 560)] + [(1, None, "", "", 1), (None, "\u00e9\x00\x00 a", "", "", 1)]
    rows += [(2000 + k, bytes(range(1, 128)).decode() * 2 + "w1", "", "", 1) for k in range(9)]
    order, contexts = 5, [defaultdict(Counter) for _ in range(6)]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    bytes_of = lambda t: b"\0" * order + (t or "").encode() + b"\0"
    for doc_id, text, *_ in rows:
        x = bytes_of(text)
        for k in range(order, len(x)):
            for o in range(order + 1):
                contexts[o][x[k - o : k]][x[k]] += not held(doc_id)

    def price(history, b):
        out, rest = set(), 1.0
        for o in range(order, -1, -1):
            seen = {s: n for s, n in contexts[o].get(history[order - o :], {}).items() if n and s not in out}
            if seen:
                whole = sum(seen.values()) + (0 if len(seen) == 256 - len(out) else len(seen))
                if b in seen:
                    return rest * seen[b] / whole
                rest *= len(seen) / whole
                out |= set(seen)
        return rest / (256 - len(out))

    got = {r.doc_id: r for r in ppm.scores(frame(spark, rows), order).collect()}
    assert len(got) == len(rows) and any(r.held_out for r in got.values())
    for doc_id, text, *_ in rows:
        x = bytes_of(text)
        want = sum(math.log10(price(x[k - order : k], x[k])) for k in range(order, len(x)))
        assert got[doc_id].score == pytest.approx(want, rel=1e-9)
    assert ppm.scores(frame(spark, []), order).count() == 0


def test_ppm_query_uses_long_contexts():
    assert registered.PPM_ORDER >= 4


def test_mixing(spark):
    weights = {"s0": 5, "s1": 2, "s2": 2}
    rows = awkward() + [(k, words(k, 40), "", f"s{k % 7}", 1) for k in range(2000, 2400)]
    docs = clashing(frame(spark, rows))
    placed = mixing.slots(docs, weights, 1000).collect()
    assert Counter((r.source, r.doc_id) for r in placed) == Counter({(s or "", i) for i, _, _, s, _ in rows})
    assert sum(r.n_bytes for r in placed) == sum(len((t or "").encode()) for _, t, *_ in rows)
    assert all(r.release <= r.slot < r.deadline for r in placed)
    owner = {}
    for r in placed:
        assert owner.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    # While no source has run out, each is less than one block from its share.
    share = {s: weights.get(s, 1) for s in {r.source for r in placed}}
    whole = sum(share.values())
    plan = mixing.schedule(spark.createDataFrame([(5, 5), (2, 4), (1, 5)], "weight long, parts long")).collect()
    assert sorted(r.at for r in plan) == list(range(14))
    done = Counter()
    for r in sorted(plan, key=lambda r: r.at):
        done[r.weight] += 1
        for w, parts in ((5, 5), (2, 4), (1, 5)):
            assert abs(done[w] - (r.at + 1) * parts / 14) < 1
    last = {s: max(r.block for r in placed if r.source == s) for s in share}
    for r in placed:
        ahead = (r.block + 1) - (r.slot + 1) * share[r.source] / whole
        assert abs(ahead) < 1 or r.block > last[r.source]
    out = mixing.mixed(docs, weights, 1000)
    assert out.columns == docs.columns and out.count() == len(rows)
    slot = {(r.source, r.doc_id): r.slot for r in placed}
    order = [slot[(r.source or "", r.doc_id)] for r in out.collect()]
    assert order == sorted(order)
    assert mixing.slots(frame(spark, []), weights, 10).count() == mixing.mixed(frame(spark, []), weights, 10).count() == 0


@pytest.mark.parametrize("n_sources, heavy", [(5000, 4), (10, 20_011)])
def test_mixing_is_exact_at_any_sum_of_weights(spark, n_sources, heavy):
    rows = [(k, "x" * 10, "", f"s{k}", 1) for k in range(1, n_sources)] + [(n_sources + k, "x" * 10, "", "s0", 1) for k in range(40)]
    placed = mixing.slots(frame(spark, rows), {"s0": heavy}, 10).collect()
    parts = {"s0": heavy, "other": n_sources - 1}
    whole, done, at, ties = sum(parts.values()), Counter(), {}, {"other": 0, "s0": 1}
    for slot in range(whole):
        ready = [(-(-(done[k] + 1) * whole // n), ties[k], k) for k, n in parts.items() if done[k] * whole // n <= slot]
        k = min(ready)[2]
        at[k, done[k]] = slot
        done[k] += 1
    member = {s: k for k, s in enumerate(sorted(f"s{k}" for k in range(1, n_sources)))}
    assert len(placed) == len(rows)
    for r in placed:
        k, n = ("s0", r.block) if r.source == "s0" else ("other", r.block * len(member) + member[r.source])
        assert r.slot == n // parts[k] * whole + at[k, n % parts[k]]
        assert (r.release, r.deadline) == (n * whole // parts[k], -(-(n + 1) * whole // parts[k]))


def test_sharding(spark):
    rows = awkward() + [(k, words(k, 40), "", "s", 1) for k in range(2000, 2400)]
    docs = clashing(frame(spark, rows))
    got = sharding.sharded(docs, 4000)
    assert got.count() == len(rows) and "shard_bytes" in got.columns and got.columns.count("shard") == 1
    shards = defaultdict(list)
    for r in got.collect():
        shards[r.shard].append(len((r.text or "").encode()))
    assert all(sum(v) <= 4000 or sum(x > 0 for x in v) == 1 for v in shards.values())
    names = [s for s in shards if "/" not in s]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    many = frame(spark, [(7, "x" * 100, "", "s", 1)] * 500 + [(8, "y", "", "s", 1)])
    paged = sharding.sharded(many, 1000).groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).collect()
    assert sum(r.b for r in paged) == 50_001 and max(r.b for r in paged) <= 1000
    assert sharding.sharded(frame(spark, []), 10).count() == 0


def test_only_oversized_buckets_split(spark):
    sized = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a"), 50).alias("text"))
    for r in sharding.shards(sized, 3000).select("shard", "shard_depth", "shard_bytes").distinct().collect():
        assert r.shard_bytes <= 3000 and len(r.shard) == r.shard_depth
        parent = [x for x in range(3000) if format(int(hashlib.md5(str(x).encode()).hexdigest()[:15], 16), "060b").startswith(r.shard[:-1])]
        assert 50 * len(parent) > 3000


URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG", "http://a.example.org/es/1", "x://b.Example.org/en/12?q", "http://b.org/en/1", "http://org/",
        "http://notorg/x", "http://t.com/de/5#x", "http://t.com/fr/", "http://t.com/de", "a://b://c.org/x", "http://h.net/" + "a/" * 5000, "http://h.net/x\ny/1"]


def rule_brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = m[1].translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), h + p, v) for v, h, p in url_templates.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    rows = [(k, u, "<html>", 1) for k, u in enumerate(URLS + URLS[5:9])] + [(None, "http://b.org/", None, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, template int")
    got = url_templates.judged(pages).collect()
    urls = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = rule_brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert url_templates.judged(pages.limit(0)).count() == 0


def test_url_templates(spark):
    rows = [(k, f"http://s.net/blog/post-{k}/view") for k in range(40)] + [(100 + k, f"http://s.net/about/p{k % 2}") for k in range(10)]
    rows += [(200 + k, f"http://x{k}.com/de/{k}") for k in range(30)] + [(300, "http://y.net/de/77")]
    got = {r.page_id: r for r in url_templates.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert {got[k].template for k in range(40)} == {"/blog/*/view"}
    assert {got[100 + k].template for k in range(10)} == {"/about/p0", "/about/p1"}
    assert got[300].rule is None and got[300].verdict == "block"


def tree_brute(urls):
    """Template of each (host, path), level by level, with plain dictionaries."""
    paths = {}
    for url in urls:
        host, path, rule, verdict = rule_brute(url)
        n, labelled, allowed = paths.get((host, path), (0, 0, 0))
        paths[host, path] = (n + 1, labelled + (rule is not None), allowed + (verdict == "allow" if rule else 0))
    template, level = {key: "" for key in paths}, 1
    while any(key[1].count("/") >= level for key in paths):
        nodes, kids = {}, {}
        child = {}
        for key, counts in paths.items():
            parts = key[1].split("/")
            if len(parts) > level:
                raw = parts[level]
                stem = re.sub(r"\.[A-Za-z]{1,5}$", "", raw)
                child[key] = "*" if re.fullmatch("[0-9]+|[0-9A-Fa-f-]{16,}", stem) else raw
                node = (key[0], template[key])
                for table, at in ((nodes, node), (kids, (*node, child[key]))):
                    table[at] = tuple(a + b for a, b in zip(table.get(at, (0, 0, 0)), counts))
        branches = {node: sum(k[:2] == node for k in kids) for node in nodes}
        for key, kid in child.items():
            node = (key[0], template[key])
            (all_n, all_labelled, all_allowed), (n, labelled, allowed) = nodes[node], kids[(*node, kid)]
            if kid != "*":
                pooled = all_allowed / all_labelled if all_labelled else 0
                gap = (allowed + 4 * pooled) / (labelled + 4) - pooled
                if labelled and gap * gap > 1.96 * 1.96 * (pooled * (1 - pooled) / (labelled + 4)):
                    pass
                elif branches[node] >= 12 and n <= 0.05 * all_n:
                    kid = "*"
                elif labelled and branches[node] > 1:
                    kid = "~"
            child[key] = kid
        for key, kid in child.items():
            template[key] += "/" + kid
        level += 1
    return template


def deep_urls():
    urls = [f"http://n.org/en/news/2024/01/{k}" for k in range(6)] + [f"http://n.org/a/b/post/{k}/view" for k in range(6)]
    urls += [f"http://b.com/{lang}/x{k}/y" for lang in ("fr", "de") for k in range(30)] + [f"http://b.com/s{k}/z" for k in range(17)]
    for host, n in (("k19", 19), ("k21", 21)):
        urls += [f"http://{host}.net/a{k}/deep/1/2/c{k}/e" for k in range(n)] + [f"http://{host}.net/big/{k}/x" for k in range(50)]
    return urls + [None, None, "http://b.com/", "http://b.com", "http://b.com//", "http://h.net/" + "/".join("abcdefghij" * 3)]


def templates_of(spark, urls):
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {rule_brute(urls[r.page_id])[:2]: r.template for r in url_templates.judged(rows).collect()}


def test_url_tree_at_any_depth(spark):
    urls = deep_urls()
    got = templates_of(spark, urls)
    assert got == tree_brute(urls)
    assert len({got["n.org", f"/en/news/2024/01/{k}"] for k in range(6)}) == 1 == len({got["n.org", f"/a/b/post/{k}/view"] for k in range(6)})
    assert {got["k21.net", f"/a{k}/deep/1/2/c{k}/e"] for k in range(21)} == {"/*/deep/*/*/*/e"}
    # One more folder changes nothing for the large ones, which differ in their labels.
    more = templates_of(spark, [*urls, "http://b.com/s17/z"])
    for found in (got, more):
        assert found["b.com", "/fr/x1/y"].startswith("/fr/") and found["b.com", "/de/x1/y"].startswith("/de/")


def test_url_tree_with_hot_keys_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_PARTS", 10)
    urls = deep_urls() + ["http://b.com/fr/x1/y"] * 200 + [None] * 100
    want = tree_brute(urls)
    rows = spark.createDataFrame([(None if k % 7 == 0 else k, u) for k, u in enumerate(urls)], "page_id long, url string")
    names = ["host", "path", "n", "child", "paths", "_salt", "_hot", "weight", "rest", "kept", "label", "rule", "verdict"]
    got = url_templates.judged(rows.select("*", *(F.lit(1).alias(n) for n in names))).collect()
    assert len(got) == len(urls) and sum(r.page_id is None for r in got) == len(range(0, len(urls), 7))
    assert all(r.template == want[r.host, r.path] for r in got)
