"""Toxicity: the scan against a search of all segments, the statistics, and held-out documents."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from casario.llm import toxicity
from llm.samples import awkward, clashing, frame, words

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def segments_brute(scores):
    """The best segment (the shortest, then first, of equal ones), then the same on both sides of it."""

    def best(lo, hi):
        sums = [(-sum(scores[a : b + 1]), b - a, a) for a in range(lo, hi) for b in range(a, hi)]
        low, length, a = min(sums, default=(0, 0, 0))
        if low >= 0:
            return []
        return [*best(lo, a), (a, a + length, -low), *best(a + length + 1, hi)]

    return best(0, len(scores))


@pytest.mark.parametrize("seed", range(40))
def test_all_maximal_segments(seed):
    dice = random.Random(seed)
    scores = [dice.choice([-3, -2, -1, -1, 1, 2, 4]) + dice.random() / 64 for _ in range(dice.randrange(40))]
    got, want = toxicity.segments(np.array(scores)), segments_brute(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_a_million_tokens_in_one_scan():
    scores = np.tile([1.0, -0.5, 2.0, -4.0, 1.5, -2.0], 200_000)
    assert len(toxicity.segments(scores)) == 400_000
    assert toxicity.segments(np.full(1000, -1.0)) == [] and toxicity.segments(np.zeros(0)) == []
    rising = np.array([x for k in range(50_000) for x in (1.0, -1.0 + 1e-7 * k)])
    assert toxicity.segments(rising)


def test_extreme_values():
    # Scores +1 and -1 with shares p and 1 - p: the root is log((1 - p) / p).
    assert math.isclose(toxicity.decay_rate(np.array([1.0, -1.0]), np.array([0.2, 0.8])), math.log(4), rel_tol=1e-9)
    one = toxicity.evidence([(0, 0, 9.0)], 100, 1.0, 0.1)
    assert math.isclose(one, 9 - math.log(10), rel_tol=1e-3)
    assert toxicity.evidence([(0, 0, 9.0), (5, 6, 9.0)], 100, 1.0, 0.1) > one
    assert toxicity.evidence([], 100, 1.0, 0.1) == 0.0 == toxicity.evidence([(0, 0, 0.1)], 10**6, 1.0, 1.0)
    assert toxicity.evidence([(0, 0, 1e6)] * 3, 5, 1.0, 0.0) == toxicity.MOST


def test_held_out_documents(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    truth = {r.doc_id: r.toxic for r in read("labels").collect()}
    rows = toxicity.toxicity(read("documents"), read("labels")).collect()
    assert len(rows) == read("documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    caught = [r >= 0.5 for r, t in held if t]
    wrong = [r >= 0.5 for r, t in held if not t]
    # Some toxic labels are on texts without any toxic word.
    assert sum(caught) >= 0.75 * len(caught) and sum(wrong) <= 0.01 * len(wrong)


def small_world(n):
    dice = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        text, toxic = words(k, 60), int(k % 4 == 0)
        if toxic:
            at = text.split()
            for _ in range(6):
                at.insert(dice.randrange(len(at)), dice.choice(["badword", "Worse!"]))
            text = " ".join(at)
        rows.append((k, text, "en", "s", 1))
        labels.append((k, 1, toxic))
    return rows, labels


def test_passages_and_copies(spark):
    rows, labels = small_world(400)
    docs, known = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.learn(docs, known)
    assert model.scores[b"badword"] > 0 and model.scores[b"worse"] > 0
    told = {r.doc_id: r for r in toxicity.passages(docs, model).collect()}
    assert all((told[k].score >= 0.5) == bool(toxic) for k, _, toxic in labels)
    for k, text, *_ in rows:
        for p in told[k].passages:
            inside = toxicity.alnum_words(text.encode())[p.first_word : p.last_word + 1]
            assert inside[0] in (b"badword", b"worse") and inside[-1] in (b"badword", b"worse")
    # Copies of one text teach no more than the text.
    again = rows + [(1000 + k, rows[0][1], "en", "s", 1) for k in range(300)]
    more = toxicity.learn(frame(spark, again), spark.createDataFrame(labels + [(1000 + k, 1, 1) for k in range(300)], LABELS))
    rare = [w for w in set(rows[0][1].split()) if w.startswith("w")]
    assert all(more.scores.get(w.encode(), -1) <= 0 for w in rare)


def test_awkward_rows(spark):
    rows, labels = small_world(300)
    odd = [(r[0] + 5000 if r[0] is not None else None, *r[1:]) for r in awkward()]
    known = labels + [(5001, 1, 1), (5002, None, None), (None, 1, 1), (7, 1, 0), (7, 1, 0), (999_999, 1, 1)]
    docs, known = frame(spark, rows + odd), spark.createDataFrame(known, LABELS)
    got = toxicity.toxicity(docs, known).collect()
    assert len(got) == len(rows) + len(odd)
    same = toxicity.toxicity(clashing(docs), known.selectExpr("*", "1 AS text", "2 AS part", "3 AS token")).collect()
    assert sorted(map(tuple, same), key=str) == sorted(map(tuple, got), key=str)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].held_out and by_id[5000].score == by_id[5001].score < 0.5
    swapped = frame(spark, [(r[0], r[1], "xx", "other", 9) for r in rows + odd])
    assert {(r.doc_id, r.score) for r in toxicity.toxicity(swapped, known).collect()} == {(r.doc_id, r.score) for r in got}


def test_nothing_to_learn_from(spark):
    rows, labels = small_world(40)
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in toxicity.toxicity(frame(spark, rows), none).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(frame(spark, []), none).collect() == []
    clean = spark.createDataFrame([(k, 1, 0) for k, *_ in labels], LABELS)
    assert {r.score for r in toxicity.toxicity(frame(spark, rows), clean).collect()} == {0.0}
