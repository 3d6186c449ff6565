"""Registered queries against their SQL, native plans, and the pipeline against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from casario.llm import decontamination, mixing, oracle, quality
from casario.llm import queries as registered
from casario.llm.common import alnum_words
from compare import connect, differences
from llm.samples import words
from llm.test_corpus import components_brute
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, name):
    assert not differences(spark, connect(SF), name, registered.queries()[name], ORACLE[name], SF)


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - {"op12_spelling_variants"}))
def test_a_row_for_each_row(spark, name):
    table = "pages" if name == "op6_url_filter" else "documents"
    assert registered.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", ["op3_mixing", "op6_url_filter", "op8_sharding"])
def test_native(spark, name):
    plan = registered.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct", "NestedLoop"))


def test_pipeline(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    good = [i for i, r in docs.items() if next(quality.scan([r.text.encode()]))[6]]
    kept = [r[0] for r in components_brute([(i, docs[i].text) for i in good]) if r[3]]
    tests = [(str(r.item_id), alnum_words(r.text.encode())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for _, w in tests for k in range(max(1, len(w) - 9))}
    clean = set()
    for i in kept:
        w = alnum_words(docs[i].text.encode())
        if not any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9)):
            clean.add(i)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == clean and len(got) == len(clean)
    assert all(all(r[c] == docs[r.doc_id][c] for c in columns) for r in got)
    shards = {}
    for r in got:
        shards[r.shard] = shards.get(r.shard, 0) + len(r.text.encode())
    assert all(n <= corpus_pipeline.SHARD_BYTES for n in shards.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "mix_sources", "shard"]
    assert decontamination.WINDOW == 10


@pytest.mark.parametrize("rows_per_file", [0, 7])
def test_mixing_reaches_the_rows_of_the_pipeline(spark, monkeypatch, rows_per_file):
    monkeypatch.setattr(corpus_pipeline, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(corpus_pipeline, "SHARD_BYTES", 20_000)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", rows_per_file)
    try:
        got = corpus_pipeline.run(spark, SF).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    own = spark.createDataFrame([(r.doc_id, r.text, r.source) for r in got], "doc_id long, text string, source string")
    placed = mixing.slots(own, corpus_pipeline.WEIGHTS, 3000).collect()
    place = {(r.source, r.doc_id): (r.slot, r.start) for r in placed}
    assert all(r.release <= r.slot < r.deadline for r in placed)
    ordered = sorted(got, key=lambda r: r.mixed_at)
    order = [place[(r.source or "", r.doc_id)] for r in ordered]
    assert len({r.mixed_at for r in got}) == len(got) and order == sorted(order)
    # While no source has run out, each is less than one block from its share.
    share = {r.source: corpus_pipeline.WEIGHTS.get(r.source, 1) for r in placed}
    last = {s: max(r.block for r in placed if r.source == s) for s in share}
    block = {(r.source, r.doc_id): r.block for r in placed}
    for r, (slot, _) in zip(ordered, order):
        k = block[(r.source or "", r.doc_id)]
        assert abs(k + 1 - (slot + 1) * share[r.source or ""] / sum(share.values())) < 1 or k > last[r.source or ""]
    # A shard's rows are together and in the mixed order.
    shards = {}
    for at, r in enumerate(got):
        shards.setdefault(r.shard, []).append((at, r.mixed_at))
    assert len(shards) > 3
    # Read back, the many small files of one task are not in order.
    for rows in shards.values() if not rows_per_file else []:
        assert [at for at, _ in rows] == list(range(rows[0][0], rows[0][0] + len(rows)))
        assert [m for _, m in rows] == sorted(m for _, m in rows)


def stages_brute(rows, items):
    """(id, text) of what the filtering stages keep, from plain comparisons."""
    good = [(i, t) for i, t in rows if t and quality_brute(t)]
    components = components_of([(i, t) for i, t in good])
    first = {}
    for (i, t), component in zip(good, components):
        key = (i is None, i or 0, len(first))
        if component not in first or key[:2] < first[component][0][:2]:
            first[component] = (key, i, t)
    windows = {tuple(w[k : k + 10]) for w in items for k in range(max(1, len(w) - 9))}
    leaks = lambda w: any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    return Counter((i, t) for _, i, t in first.values() if not leaks(alnum_words(t.encode())))


def quality_brute(text):
    """The base rule, and the share of the words in repeats of 8 words or more and the longest of them."""
    w = text.encode().split()
    if len(w) < 20:
        return False
    seen = {}
    for k in range(len(w) - 7):
        seen.setdefault(tuple(w[k : k + 8]), []).append(k)
    hit = {p for at in seen.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
    longest = max((m for m in range(8, len(w)) if len({tuple(w[k : k + m]) for k in range(len(w) - m + 1)}) < len(w) - m + 1), default=0)
    covered = sum(len(w[p].decode()) for p in hit) / sum(len(x.decode()) for x in w)
    repetitive = covered > quality.MAX_COVERED or longest >= quality.MIN_LONGEST and longest > quality.MAX_LONGEST * len(w)
    return not (100 * len(hit) > 30 * len(w) or repetitive)


def components_of(rows):
    shingles = []
    for _, t in rows:
        w = t.encode().lower().split()
        shingles.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x = len(shingles[a] & shingles[b])
            if 100 * x >= 75 * (len(shingles[a]) + len(shingles[b]) - x):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return label


def test_pipeline_on_awkward_rows(spark, tmp_path):
    item = words(700, 14)
    texts = [words(800 + k, 30 + k) for k in range(24)]
    repeats = [words(60 + k, 28) + " " + words(70, m) + " " + words(90 + k, 40) + " " + words(70, m) for k, m in enumerate((6, 9, 12, 26, 40))]
    rows = [(k, t) for k, t in enumerate(texts + repeats)]
    rows += [(None, texts[0]), (None, texts[1]), (None, words(5, 60)), (None, words(5, 60)), (3, texts[3]), (4, words(6, 50)), (None, None), (50, "")]
    rows += [(60, words(8, 40) + " " + item + " " + words(9, 40)), (61, words(8, 40)), (62, " ".join(words(9, 30).split()[:20] + item.split()[:9]))]
    names = ["doc", "row", "print", "slot", "id", "shard", "mixed_at", "n", "kept", "first"]
    docs = spark.createDataFrame([(i, t, None if k % 5 else "en", f"src{k % 3}" if k % 4 else None, None) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.select("*", *(F.lit(7).alias(c) for c in names)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = stages_brute(rows, [alnum_words(item.encode())])
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert len({r.mixed_at for r in got}) == len(got) and all(r.kept == r.first == r.slot == 7 for r in got)
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
