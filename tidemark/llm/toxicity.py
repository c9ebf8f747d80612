"""Toxic passages by maximum-scoring segment search.

Tokens get log-odds of toxic against other documents, from document counts with Dirichlet priors: a word's prior is the rate of its
family (its first ``FAMILY`` letters), a family's prior the overall rate, so that unseen forms of a known family count too. A drift is
taken off, so that ordinary text scores below zero on average. One linear scan finds all maximal-scoring segments of a text. Their
scores S are set against extreme-value statistics: the tail falls as K n exp(-lambda S) for n tokens, with lambda and K fitted on
other documents that are not toxic; a document's evidence is the best p-value of the sum of its r highest segments over all r, and a logistic
curve fitted on the same documents turns it into a score from 0 to 1.

The fit reads at most ``LABELLED`` labelled documents, dealt by a hash of their ids, none of them held out (crc32 of the id as text,
mod 5, is 0). The model's size is bounded by that sample. Scoring reads whole texts and nothing else.

Null and empty texts: no tokens, the curve's lowest score. Null ids or labels are not learned from; of repeated labels the highest holds.
Without labelled documents of both kinds nothing is learned: all scores are next to 0. An empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

LABELLED, FAMILY, DRIFT, MIN_DOCS = 20_000, 4, 0.5, 2
#: Weight of a prior, in documents: a family's in the overall rate, a word's in its family's.
FAMILY_WEIGHT, WORD_WEIGHT, CAUTION = 40.0, 40.0, 2.5
FOLDS = 5
CACHE = 300_000
EDGE = "\"'.,;:!?()[]{}#*$%&|<>-_"


def normal(word: str) -> str:
    return word.strip(EDGE).lower()


@dataclass
class Model:
    """Token scores and the fitted tail; ``family`` and ``word`` hold scores before the drift."""

    word: dict[str, float]
    family: dict[str, float]
    tail: float = 1.0
    k: float = 1.0
    curve: tuple[float, float] = (0.0, 1.0)
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def tokens(self, words: list[str]) -> np.ndarray:
        cache = self.cache
        new = set(words).difference(cache)
        if new:
            if len(cache) + len(new) > CACHE:
                cache.clear()
                new = set(words)
            for w in new:
                n = normal(w)
                s = self.word.get(n)
                cache[w] = (self.family.get(n[:FAMILY], 0.0) if s is None else s) - DRIFT
        return np.fromiter(map(cache.__getitem__, words), np.float64, len(words))

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        return segments(self.tokens(words)) if words else []

    def evidence(self, n: int, scores: list[float]) -> float:
        """-ln of the smallest p-value that the r highest of these segment scores give, over all r whose r-th score is above chance.

        scores: highest first.
        """
        total, best, chance = 0.0, 0.0, math.log(max(self.k * n, 1e-9))
        for r, s in enumerate(scores, 1):
            if self.tail * s <= chance:
                break
            total += self.tail * s - chance
            # P(sum of the r highest >= total) ~ exp(-total) total^(r-1) / (r! (r-1)!); ln r for having looked at several r
            p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -p - math.log(r + 1))
        return best

    def score(self, text: str | None) -> float:
        words = (text or "").split()
        return self.curve_at(self.evidence(len(words), sorted((s for s, _, _ in self.segments(words)), reverse=True)))

    def clear(self, n: int, score: float, p_value: float) -> bool:
        """Whether a segment's own p-value is below this one."""
        return self.evidence(n, [score]) > -math.log(p_value)

    def curve_at(self, x: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] + self.curve[1] * squeezed(x)))))


def squeezed(x: float) -> float:
    return math.log1p(x)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end), none overlapping another, in one scan of linear time.

    Each positive token opens a candidate with the sums before and behind it; it takes in the earlier candidates, back to the nearest
    with a smaller sum before, as long as that one ends lower. Each candidate links to that nearest one, so what was passed once isn't
    looked at again.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)]).tolist()
    stack: list[tuple[float, float, int, int, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        left, right, start, j = sums[i], sums[i + 1], i, len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                break
            left, _, start, _, before = stack[j]
            del stack[j:]
            j = before
        stack.append((left, right, start, i + 1, j))
    return [(r - a, s, e) for a, r, s, e, _ in stack]


def held_out_of(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == 0


def training_texts(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """text, toxic, fitted: at most ``limit`` rows of labels that are not held out, with their texts; a quarter is not fitted but calibrates.
    An id is one row, however many documents have it: of several texts the least stands for it, folded where they are read."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    some = known.filter(~held_out_of("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    one = docs.join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return one.select("text", "toxic", (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) > 0).alias("fitted"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from texts of docs (doc_id, text) with labels (doc_id, toxic)."""
    train = common.written(training_texts(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))
    n = {r["toxic"]: r["n"] for r in train.filter("fitted").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model({}, {}, curve=(-30.0, 0.0))

    def count():
        def f(texts, toxic):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(texts, toxic, strict=True):
                words = set(map(normal, t.split()))
                seen[y > 0].update(words)
                seen[y > 0].update({f" {w[:FAMILY]}" for w in words if len(w) > FAMILY})
            keys = list(seen[0].keys() | seen[1].keys())
            return [keys, [seen[0][k] for k in keys], [seen[1][k] for k in keys]]

        return f

    counts = common.map_rows(train.filter("fitted"), ["text", "toxic"], {"token": "string", "other": "long", "toxic": "long"}, count)
    counts = counts.groupBy("token").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    # words that no toxic text has twice say no more than their family
    useful = counts.filter(F.when(F.col("token").startswith(" "), F.col("other") + F.col("toxic") >= MIN_DOCS).otherwise(F.col("toxic") >= MIN_DOCS))
    rate = n[1] / (n[0] + n[1])
    model = learn({r["token"]: (r["other"], r["toxic"]) for r in useful.collect()}, rate)

    def scan():
        def f(texts, toxic):
            rows = []
            for t, y in zip(texts, toxic, strict=True):
                words = t.split()
                found = sorted((s for s, _, _ in model.segments(words)), reverse=True)
                values, times = np.unique(np.round(model.tokens(words), 1), return_counts=True)
                rows.append((y, len(words), found, [*values.tolist(), *times.astype(float).tolist()]))
            return [list(c) for c in zip(*rows, strict=True)]

        return f

    sample = common.map_rows(train.filter("not fitted"), ["text", "toxic"], {"toxic": "int", "n": "long", "best": "array<double>", "histogram": "array<double>"}, scan)
    return calibrate(model, [(r["toxic"], r["n"], list(r["best"]), list(r["histogram"])) for r in sample.collect()])  # at most LABELLED rows


def learn(counts: dict[str, tuple[int, int]], rate: float) -> Model:
    """Log-odds against the overall rate, with the priors named above, less CAUTION standard deviations, at least 0."""

    def odds(toxic: float, other: float) -> float:
        sigma = math.sqrt(1 / toxic + 1 / other)
        return max(0.0, math.log(toxic / other) - math.log(rate / (1 - rate)) - CAUTION * sigma)

    family, family_rate = {}, {}
    for t, (other, toxic) in counts.items():
        if t.startswith(" "):
            family_rate[t[1:]] = (toxic + FAMILY_WEIGHT * rate) / (other + toxic + FAMILY_WEIGHT)
            family[t[1:]] = odds(toxic + FAMILY_WEIGHT * rate, other + FAMILY_WEIGHT * (1 - rate))
    word = {}
    for t, (other, toxic) in counts.items():
        if not t.startswith(" "):
            prior = family_rate.get(t[:FAMILY], rate) if len(t) > FAMILY else rate
            word[t] = odds(toxic + WORD_WEIGHT * prior, other + WORD_WEIGHT * (1 - prior))
    return Model({t: s for t, s in word.items() if s or family.get(t[:FAMILY])}, {t: s for t, s in family.items() if s})


def calibrate(model: Model, sample: list[tuple[int, int, list[float], list[float]]]) -> Model:
    """Fits the tail on texts that are not toxic (lambda: mean of exp(lambda s) over their tokens is 1; K: most likely), then the curve."""
    histogram: Counter = Counter()
    for toxic, _, _, h in sample:
        if not toxic:
            half = len(h) // 2
            for v, c in zip(h[:half], h[half:], strict=True):
                histogram[v] += c
    values, weights = np.array(list(histogram)), np.array(list(histogram.values()))
    low, high = 1e-3, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        with np.errstate(over="ignore"):
            low, high = (middle, high) if np.sum(weights * np.exp(middle * values)) < np.sum(weights) else (low, middle)
    model.tail = low
    null = [(n, best[0] if best else 0.0) for toxic, n, best, _ in sample if not toxic and n]
    model.k = len(null) / max(1e-9, sum(n * math.exp(-model.tail * s) for n, s in null))
    x = np.array([squeezed(model.evidence(n, best)) for _, n, best, _ in sample])
    y = np.array([float(toxic > 0) for toxic, *_ in sample])
    if not 0 < y.mean() < 1:
        model.curve = (-6.0, 4.0)
        return model
    curve, ridge = np.array([math.log(y.mean() / (1 - y.mean())), 0.0]), np.array([0.01, 0.1])
    columns = np.stack([np.ones(len(x)), x])

    def loss(c: np.ndarray) -> float:
        return float(np.sum(np.logaddexp(0, c @ columns) - y * (c @ columns)) + np.sum(ridge * c * c) / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-(curve @ columns)))
        gradient = columns @ (p - y) + ridge * curve
        step = np.linalg.solve((columns * p * (1 - p)) @ columns.T + np.diag(ridge), gradient)
        while loss(curve - step) > loss(curve) and np.abs(step).max() > 1e-9:
            step = step / 2
        curve = curve - step
        if np.abs(step).max() < 1e-9:
            break
    a, b = curve
    model.curve = (float(a), float(b))
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, n_segments (with a score whose own p-value is below 0.05), best_segment (start:end in words)."""
    schema = {"doc_id": "long", "score": "double", "predicted": "int", "n_segments": "long", "best_segment": "string"}
    shared = df.sparkSession.sparkContext.broadcast(model)  # as large as the sample's vocabulary at most

    def make():
        model = shared.value

        def f(ids, texts):
            rows = []
            for i, t in zip(ids, texts, strict=True):
                words = (t or "").split()
                found = sorted(model.segments(words), reverse=True)
                s = model.curve_at(model.evidence(len(words), [x for x, _, _ in found]))
                clear = 0
                while clear < len(found) and model.clear(len(words), found[clear][0], 0.05):
                    clear += 1
                rows.append((i, s, int(s >= 0.5), clear, f"{found[0][1]}:{found[0][2]}" if found else ""))
            return [list(c) for c in zip(*rows, strict=True)]

        return f

    return common.map_rows(df, [id_col, text_col], schema, make)


def passages(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", p_value: float = 0.05) -> DataFrame:
    """doc_id, start, end (code points, end exclusive), segment_score, text: every significant toxic passage."""
    schema = {"doc_id": "long", "start": "long", "end": "long", "segment_score": "double", "text": "string"}
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def f(ids, texts):
            rows = []
            for i, t in zip(ids, texts, strict=True):
                places = [m.span() for m in re.finditer(r"\S+", t or "")]
                words = [t[a:b] for a, b in places]
                for s, first, last in model.segments(words):
                    if model.clear(len(words), s, p_value):
                        a, b = places[first][0], places[last - 1][1]
                        rows.append((i, a, b, s, t[a:b]))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in schema]

        return f

    return common.map_rows(df, [id_col, text_col], schema, make)


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and more for each row of docs."""
    return score(docs, fit(docs, labels)).withColumn("held_out", F.coalesce(held_out_of("doc_id"), F.lit(False)))


def without_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df without the rows whose text the model calls toxic; all its columns stay."""
    common.find_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score)

    return df.filter(toxic(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) < 0.5)
