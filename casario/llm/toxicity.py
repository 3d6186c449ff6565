"""Toxicity: significant passages by maximum-scoring segment search over token log-odds.

Learning, on a sample of labelled documents (`SAMPLE_DOCS`, a bound that is a parameter):

1. Tokens are counted in toxic and in other documents.  Occurrences between the same two
   neighbours count once, so copies of a text teach no more than the text.
2. A token's log-odds have a Dirichlet prior, the token's share in all the sample, and are drawn
   in towards 0 by `SHRINK` standard deviations; what is left above 0 speaks for toxicity.  Every
   token costs `DRIFT` besides, so a text without evidence scores below 0 everywhere.
3. Extreme-value theory gives the number of segments with a score of S or more that n tokens of
   harmless text have by chance: K n exp(-lambda S).  lambda is the positive root of the mean of
   exp(lambda s) over harmless tokens being 1; K is fitted to the best segments of harmless
   documents.  That and the last step use a part of the sample (`CALIBRATION`) of which the
   log-odds have learned nothing.
4. A logistic curve turns a document's evidence into its score.

Scoring: one linear scan finds all maximal scoring segments of a text; those expected `SIGNIFICANT`
times or less by chance are its passages.  Its evidence is the least probability that harmless
text of its length has r segments as good as its r best, over all r.

Rows whose crc32 of the id is 0 modulo `FOLDS` are held out: nothing is learned from them.  A null
id is an empty one, thus held out.  Of repeated ids one text (the least) is learned from; a label
is 1 if any row says so, and null labels are none.  Null and empty texts have no evidence.  Without
toxic and other documents to learn from, the score of every text is the smoothed share of toxic
labels (0 without labels).  Equal texts get equal scores, whatever the other columns hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.llm.common import alnum_words, findings, struct_udf, written

FOLDS = 5
#: Labelled documents that are learned from (about), and the share of them kept for calibration.
SAMPLE_DOCS = 10_000
CALIBRATION = 0.3
#: Tokens that the prior weighs, in parts of all tokens of the sample.
PRIOR = 0.02
SHRINK = 2.0
DRIFT = 0.25
#: Expected number by chance up to which a segment is a passage.
SIGNIFICANT = 0.05
#: Tokens of the model; of more the ones with the clearest log-odds stay.
MODEL_TOKENS = 50_000
#: The evidence of a document is at most this (in nats).
MOST = 300.0

SCHEMA = "score double, evidence double, n_passages long, passages array<struct<first_word: int, last_word: int, score: double, expected: double>>"


@dataclass
class Model:
    """Token scores (others have -DRIFT), the extreme-value parameters, and the logistic curve."""

    scores: dict[bytes, float] = field(default_factory=dict)
    decay: float = 1.0
    chance: float = 0.0
    slope: float = 0.0
    offset: float = -math.inf


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(first, last, score) of all maximal scoring segments, in order, in linear time.

    Only tokens above 0 are visited; what lies between is a difference of running sums.
    """
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    out: list[list] = []  # first, last, sum before it, sum with it, and the nearest earlier one with a lesser sum before it
    for at in np.flatnonzero(scores > 0).tolist():
        first, low, high = at, sums[at], sums[at + 1]
        while True:
            k = len(out) - 1
            while k >= 0 and out[k][2] >= low:
                k = out[k][4]
            if k < 0 or out[k][3] >= high:
                out.append([first, at, low, high, k])
                break
            # The segment grows to the left, over all that came after that one.
            first, low = out[k][0], out[k][2]
            del out[k:]
    return [(a, b, float(high - low)) for a, b, low, high, _ in out]


def evidence(found: list[tuple[int, int, float]], n: int, decay: float, chance: float) -> float:
    """- log of the least probability, over r, of r segments as good as the r best of n harmless tokens."""
    best = 0.0
    for r, score in enumerate(sorted((s for *_, s in found), reverse=True), 1):
        expected = chance * n * math.exp(-min(decay * score, 700.0))
        if expected >= r:
            break
        # Poisson tail of r or more: the first term, and a geometric bound for the others.
        log_tail = r * math.log(expected) - expected - math.lgamma(r + 1) - math.log1p(-expected / (r + 1)) if expected > 0 else -MOST
        best = max(best, -log_tail)
    return min(best, MOST)


def token_scores(text: bytes | None, scores: dict[bytes, float]) -> np.ndarray:
    words = alnum_words(text)
    return np.fromiter((scores.get(w, -DRIFT) for w in words), np.float64, len(words))


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def scan(texts: list[bytes | None], model: Model) -> Iterator[tuple]:
    for text in texts:
        values = token_scores(text, model.scores)
        found = segments(values)
        seen = evidence(found, len(values), model.decay, model.chance)
        passages = [(a, b, s, model.chance * len(values) * math.exp(-min(model.decay * s, 700.0))) for a, b, s in found]
        passages = [p for p in passages if p[3] <= SIGNIFICANT]
        yield logistic(model.slope * seen + model.offset), seen, len(passages), passages


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, part): labelled documents to learn from; `part` is a number between 0 and 1."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = written(known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))
    n = known.count()
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(n, 1))) < SAMPLE_DOCS).select(F.col("doc_id").alias("labelled"), "toxic")
    # About SAMPLE_DOCS rows of a number and a bit.
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("text")), F.lit(1000)) / 1000
    return written(chosen.select(F.col("text").cast("binary").alias("text"), "toxic", part.alias("part")))


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct (token, neighbours, toxic) of a batch of documents."""
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = alnum_words(text)
            framed = [b"", *words, b""]
            keys = {(w, xxhash.xxh3_64_intdigest(framed[k] + b" " + w + b" " + framed[k + 2]) - 2**63) for k, w in enumerate(words)}
            yield pd.DataFrame({"token": [w for w, _ in keys], "around": [h for _, h in keys], "toxic": [bool(toxic)] * len(keys)})


def counted(texts: DataFrame) -> DataFrame:
    """(token, toxic_n, other_n) over (text, toxic) rows."""
    rows = texts.select("text", "toxic").mapInPandas(_contexts, "token binary, around long, toxic boolean").distinct()
    return rows.groupBy("token").agg(F.count_if("toxic").alias("toxic_n"), F.count_if(~F.col("toxic")).alias("other_n"))


def log_odds(counts: DataFrame, toxic_all: int, other_all: int) -> DataFrame:
    """`counts` with `odds`, drawn in, `z`, and the share of harmless text that the token is."""
    weight = F.lit(PRIOR * (toxic_all + other_all))
    prior = weight * (F.col("toxic_n") + F.col("other_n")) / (toxic_all + other_all)
    toxic, other = F.col("toxic_n") + prior, F.col("other_n") + prior
    share = other / (other_all + weight)
    raw = F.log(toxic / (toxic_all + weight)) - F.log(share)
    spread = F.sqrt(1 / toxic + 1 / other)
    drawn = F.signum(raw) * F.greatest(F.abs(raw) - SHRINK * spread, F.lit(0.0))
    return counts.select("token", drawn.alias("odds"), (F.abs(raw) / spread).alias("z"), share.alias("share"))


def clearest(odds: DataFrame) -> pd.DataFrame:
    """The tokens with odds other than 0; of more than MODEL_TOKENS those above a least z."""
    kept = odds.filter("odds != 0")
    steps = kept.groupBy(F.floor(F.least(F.col("z"), F.lit(1000.0)) * 100).alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step"))
    total, least = 0, 0
    for row in steps.collect():
        total += row.n
        if total > MODEL_TOKENS:
            least = row.step + 1
            break
    return kept.filter(F.col("z") * 100 >= least).toPandas()


def decay_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(x * score)) = 1; the rest of the shares scores -DRIFT."""
    rest = max(0.0, 1.0 - shares.sum())
    total = lambda x: float((shares * np.exp(x * scores)).sum()) + rest * math.exp(-x * DRIFT)
    low, high = 0.0, 1.0
    while total(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return high


def fitted_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a weak pull towards 0."""
    design = np.column_stack((x, np.ones(len(x))))
    weights, pull = np.zeros(2), np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - pull @ weights
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + pull, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sample(docs, labels)
    n, n_toxic = rows.agg(F.count("*"), F.count_if("toxic")).first()
    base = n_toxic / (n + 1)
    plain = Model(offset=math.log(base / (1 - base)) if base else -math.inf)
    counts = written(counted(rows.filter(F.col("part") >= CALIBRATION)))
    toxic_all, other_all = (x or 0 for x in counts.agg(F.sum("toxic_n"), F.sum("other_n")).first())
    if not toxic_all or not other_all:
        return plain
    tokens = clearest(log_odds(counts, toxic_all, other_all))
    values = tokens["odds"].to_numpy() - DRIFT
    model = Model(dict(zip(map(bytes, tokens["token"]), values.tolist())))
    if not (values > 0).any():
        return plain
    model.decay = decay_rate(values, tokens["share"].to_numpy())

    def best(texts: list[bytes | None]) -> Iterator[tuple]:
        for text in texts:
            scored = token_scores(text, model.scores)
            yield len(scored), [s for *_, s in segments(scored)]

    found = struct_udf(best, "n long, scores array<double>")("text")
    kept = rows.filter(F.col("part") < CALIBRATION).select("toxic", found.alias("found")).select("toxic", "found.*").toPandas()
    if kept["toxic"].nunique() < 2:
        return plain
    harmless = kept[~kept["toxic"]]
    most = np.array([max(s, default=0.0) for s in harmless["scores"]])
    # Documents without any segment only tell that their best is below all that are seen.
    model.chance = max(1, int((most > 0).sum())) / max(float((harmless["n"] * np.exp(-model.decay * most)).sum()), 1.0)
    seen = [evidence([(0, 0, s) for s in scores], n, model.decay, model.chance) for n, scores in zip(kept["n"], kept["scores"])]
    model.slope, model.offset = fitted_curve(np.array(seen), kept["toxic"].to_numpy(float))
    return model


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """A row per document: score, evidence, and its significant passages (words from 0)."""
    return findings(docs, struct_udf(lambda texts: scan(texts, model), SCHEMA)(F.col("text").cast("binary")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: whether it was held out, its score, the verdict, and how many passages."""
    return passages(docs, learn(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages"
    )
