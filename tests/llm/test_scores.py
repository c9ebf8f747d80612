import time
import zlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity

from .conftest import EDGE_IDS, EDGE_TEXTS, words


def maximal(scores):
    """All maximal-scoring segments by their definition: cut out the best one, go on left and right of it."""

    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (top is None or total > top[0] or (total == top[0] and j + 1 - i < top[2] - top[1])):
                    top = (total, i, j + 1)
        return [] if top is None else best(lo, top[1]) + [top] + best(top[2], hi)

    return best(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -2.0, -1.25, 1.0, 2.5, 4.75, 7.125]), max_size=14), st.randoms())
def test_segments_equal_the_definition(values, r):
    scores = [v + r.randrange(-1000, 1000) * 2.0**-20 for v in values]  # no ties
    assert [(round(s, 9), a, b) for s, a, b in toxicity.segments(np.array(scores, float))] == [(round(s, 9), a, b) for s, a, b in maximal(scores)]


def labelled(n, seed):
    r = random.Random(seed)
    texts, toxic = [], []
    for k in range(n):
        w = words(r.randrange(5, 120), seed * 10_000 + k, 900).split()
        if k % 6 == 0:
            for _ in range(r.randrange(3, 7)):
                w.insert(r.randrange(len(w)), r.choice(["idiotic", "rotten,", "Vileword", "vilewords"]))
        texts.append(" ".join(w))
        toxic.append(int(k % 6 == 0))
    return texts, toxic


def test_held_out_accuracy(spark, make, edge, empty):
    texts, toxic = labelled(1500, 4)
    docs = make(texts)
    labels = spark.createDataFrame([(k, y, 1) for k, y in enumerate(toxic)] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, text int")
    got = toxicity.digests(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert 200 < len(held) < 400 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == toxic[r.doc_id] for r in held) / len(held) > 0.97
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(edge, model).collect()
    assert sorted(str(r.doc_id) for r in scored) == sorted(map(str, EDGE_IDS)) and all(r.predicted == 0 for r in scored if r.doc_id in (0, 1, 2))
    assert toxicity.score(empty, model).count() == 0
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    found = toxicity.passages(docs, model).collect()
    assert found and all(texts[r.doc_id][r.start : r.end] == r.text for r in found)
    for few in (labels.filter("toxic = 0"), labels.limit(0)):
        nothing = toxicity.fit(docs, few)
        assert toxicity.without_toxic(docs, nothing).count() == docs.count() and toxicity.score(docs, nothing).filter("score > 0.01").count() == 0


def test_score_follows_from_the_model(spark, make):
    """Score by the definitions: family or word odds, maximal segments, the tail's p-value over all numbers of segments, the curve."""
    texts, toxic = labelled(700, 6)
    labels = spark.createDataFrame([(k, y) for k, y in enumerate(toxic)], "doc_id long, toxic int")
    model = toxicity.fit(make(texts), labels)
    for text in texts[:120]:
        w = text.split()
        odds = [(model.word[n] if (n := toxicity.normal(x)) in model.word else model.family.get(n[: toxicity.FAMILY], 0.0)) - toxicity.DRIFT for x in w]
        # longer texts would take long by definition: cut to what holds all their segments
        found = sorted((s for s, _, _ in maximal([round(o, 12) for o in odds[:60]])), reverse=True)
        best, total = 0.0, 0.0
        for r, s in enumerate(found, 1):
            excess = model.tail * s - math.log(max(model.k * len(w[:60]), 1e-9))
            if excess <= 0:
                break
            total += excess
            best = max(best, total - math.log(total ** (r - 1) / (math.factorial(r) * math.factorial(r - 1))) - math.log(r + 1))
        want = 1 / (1 + math.exp(-(model.curve[0] + model.curve[1] * math.log1p(best))))
        assert abs(model.score(" ".join(w[:60])) - want) < 1e-6


def test_an_id_is_one_row_of_the_sample(spark):
    """A labelled id that a third of all rows have is one row, and its least text stands for it."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(400)] + [(k, "other") for k in range(2, 60)] + [(60, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 61)] + [(1, 1)] * 50, "doc_id long, toxic int")
    got = toxicity.training_texts(docs, labels)
    known = {k for k in range(1, 61) if zlib.crc32(str(k).encode()) % 5}
    assert got.count() == len(known) and got.filter("text like 'text%'").collect()[0].text == "text 0" if 1 in known else True


def test_scan_takes_linear_time():
    """Alternating signs, rising and falling sums: twice the tokens take about twice the time."""
    r = np.random.default_rng(3)
    for pattern in (lambda n: np.resize([1.0, -1.0], n), lambda n: np.resize([1.0, -1.5], n), lambda n: np.resize([1.5, -1.0], n), lambda n: r.normal(0, 1, n)):
        seconds = []
        for n in (100_000, 200_000):
            x, began = pattern(n), time.process_time()
            toxicity.segments(x)
            seconds.append(time.process_time() - began)
        assert seconds[1] < 3 * seconds[0] + 0.05


def brute_measures(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().strip()]
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + d for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for d in range(8)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def quality_texts():
    r = random.Random(9)
    out = list(EDGE_TEXTS)
    for k in range(150):
        t = words(r.randrange(15, 200), k)
        out.append(t if k % 10 else " ".join(x + "###" for x in t.split()))
    out += ["\n".join([words(12, 1)] * 5), words(10, 3) + " " + words(30, 2) + " x " + words(30, 2), "line\nline\n \nline\n"]
    return out


def test_measures_equal_brute_force():
    for t in quality_texts():
        assert quality.measure(t)[:5] == brute_measures(t)


def brute_verdicts(rows):
    """Verdicts with exact arithmetic on sketches that are built by hand."""
    feats, sketches, langs = {}, {}, {}
    def edges(v):
        """The least and the most value of a value's bucket."""
        width = 1
        while v >= 128 * width:
            width *= 2
        return v - v % width, v - v % width + width - 1

    for k, (_, text, lang, source) in enumerate(rows):
        n, chars, sym, _, _, upper = quality.measure(text)
        per = lambda a, b, s: s * a // b if b else 0
        feats[k] = {"symbols": per(sym, chars, 10_000), "upper": per(upper, chars, 10_000), "word_length": per(chars, n, 100)}
        for f, v in feats[k].items():
            sketches.setdefault((lang, source, f), Counter())[edges(v)] += 1
            langs.setdefault((lang, f), Counter())[edges(v)] += 1
    out = []
    for k, (i, text, lang, source) in enumerate(rows):
        n, _, _, _, rep, *_ = quality.measure(text)
        failed, beyond = n < 20 or 100 * rep > 30 * n, False
        for f, start in (("symbols", 75), ("upper", 50), ("word_length", 50)):
            whole = sum(langs[lang, f].values())
            w = Counter({b: c * whole for b, c in sketches[lang, source, f].items()})
            w.update({b: c * quality.PRIOR for b, c in langs[lang, f].items()})
            total = sum(w.values())

            def at(q, w=w, total=total):
                below = 0
                for b in sorted(w):
                    below += w[b]
                    if below * 100 >= total * q:
                        return b

            middle, low = at(start)[1], at(25)[0]
            beyond |= feats[k][f] > middle + 12 * (middle - low + 1)
        out.append(str((i, failed, not failed and not beyond)))
    return sorted(out)


def test_verdicts(make, empty):
    df = make(quality_texts()).cache()
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]
    got = quality.assess(df).collect()
    assert sorted(str((r.doc_id, r.base_failed, r.kept)) for r in got) == brute_verdicts(rows)
    assert any(r.kept for r in got) and any(not r.kept and not r.base_failed for r in got)
    assert quality.assess(empty).count() == 0


def test_junk_does_not_move_its_own_fence(spark):
    """20 of 100 documents of a source are full of signs: they go, the clean ones stay."""
    clean = [words(60, k) for k in range(80)]
    junk = [" ".join(w + "#$%"[: 1 + n % 3] for n, w in enumerate(words(60, 100 + k).split())) for k in range(20)]
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(clean + junk)], "doc_id long, text string, lang string, source string")
    assert sorted(r.doc_id for r in quality.assess(df).filter("kept").collect()) == list(range(80))


def test_what_is_usual_in_a_source_passes_there_only(spark):
    """The same text in two sources: one of plain prose, one in which most texts are full of signs and capitals."""
    odd = [" ".join(w.upper() + "#$" * (n % 2) for n, w in enumerate(words(60, 500 + k).split())) for k in range(300)]
    rows = [(k, words(60, k), "en", "prose") for k in range(400)] + [(1000 + k, words(60, 900 + k), "en", "lists") for k in range(100)]
    rows += [(2000 + k, t, "en", "lists") for k, t in enumerate(odd)] + [(3000, odd[0], "en", "prose"), (3001, odd[0], "en", "lists")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.assess(df).filter("kept").collect()}
    assert 3000 not in kept and 3001 in kept and set(range(400)) <= kept
    fences = {r.origin: r for r in quality.thresholds(quality.sketch(quality.measures(df))).collect()}
    assert all(fences["=lists"][f"{f}_fence"] > fences["=prose"][f"{f}_fence"] for f in ("symbols", "upper"))


def test_sketches_merge(make):
    df = make(quality_texts())
    m = quality.measures(df)
    whole = {tuple(r) for r in quality.sketch(m).collect()}
    parts = quality.sketch(m.filter("doc_id % 2 = 0")).union(quality.sketch(m.filter("doc_id % 2 = 1"))).groupBy("language", "origin", "feature", "bucket").agg(F.sum("n"))
    assert {tuple(r) for r in parts.collect()} == whole
