import hashlib
import random
import re
from collections import Counter

import numpy as np

import corpus_pipeline
from tidemark.llm import passages, units

from .conftest import EDGE_IDS, EDGE_TEXTS, words

N = passages.LENGTH


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + N] for r in raws for i in range(len(r) - N + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - N + 1):
            if seen[r[i : i + N]] > 1:
                gone[i : i + N] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((len(r), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    """Shared passages of lengths about the limit, cut at any byte, repeated inside texts, in copies, in runs of one letter, overlapping."""
    r = random.Random(seed)
    pool = [words(400, seed * 100 + k) for k in range(4)]
    out = []
    for k in range(60):
        parts = []
        for _ in range(r.randrange(1, 5)):
            p = r.choice(pool)
            at, n = r.randrange(len(p) - 900), r.choice([200, 390, 398, 399, 400, 401, 402, 420, 500, 800])
            parts += [words(r.randrange(0, 40), r.random()), p[at : at + n]]
        out.append("".join(parts))
    line = "a very common line of some length, again and again.\n"
    return [*out, out[0], out[1], out[1], "z" * 900, "z" * 450, "q" + "z" * 420, line * 30, line * 9 + words(100, 5), None, ""]


def test_equal_to_brute_force(make):
    for seed in (1, 2, 3):
        t = texts(seed)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in passages.digests(make(t)).collect()}
        want = brute(t)
        assert [k for k in range(len(t)) if got[k] != want[k]] == []


def test_rows(edge, empty):
    got = sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in passages.digests(edge).collect())
    assert got == sorted(str((i, *b)) for i, b in zip(EDGE_IDS, brute(EDGE_TEXTS), strict=True))
    assert passages.digests(empty).count() == 0


def test_text_form_keeps_letters_whole(make):
    shared = "é" * 250
    df = make(["x" + shared + "y", "ab" + shared + "c", "alone"])
    got = {r.doc_id: r.text for r in passages.without_passages(df).collect()}
    assert got == {0: "xy", 1: "abc", 2: "alone"}
    assert passages.without_passages(df).columns == df.columns


def brute_words(texts):
    """What is left of texts without the passages of 51 words and the strings of N bytes that stand elsewhere too."""
    raws = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", r)] for r in raws]
    units = [[r[a:b] for a, b in p] for r, p in zip(raws, places, strict=True)]
    seen = Counter(tuple(u[i : i + 51]) for u in units for i in range(len(u) - 50))
    strings = Counter(r[i : i + N] for r in raws for i in range(len(r) - N + 1))
    out = []
    for r, p, u in zip(raws, places, units, strict=True):
        gone = np.zeros(len(r), bool)
        words_gone = {i + k for i in range(len(u) - 50) if seen[tuple(u[i : i + 51])] > 1 for k in range(51)}
        for i in words_gone:
            # white space between two words that go goes too
            gone[p[i][0] : p[i + 1][0] if i + 1 in words_gone else p[i][1]] = True
        for i in range(len(r) - N + 1):
            if strings[r[i : i + N]] > 1:
                gone[i : i + N] = True
        ends = np.cumsum([len(c.encode()) for c in r.decode()])
        # letters that would be cut in part stay whole
        out.append("".join(c for c, end in zip(r.decode(), ends, strict=True) if not gone[end - len(c.encode()) : end].all()))
    return out


def test_pipeline_cuts_passages_of_over_50_words(make, spark):
    """Planted passages of 30 to 65 words, of one letter upwards; 50 words and fewer stay."""
    r = random.Random(9)
    out = []
    for k, n in enumerate([30, 49, 50, 51, 52, 55, 58, 60, 64, 65]):
        for size in (1, 3, 6):
            passage = " ".join("".join(r.choice("abcdefgh") for _ in range(size)) for _ in range(n))
            own = lambda: " ".join(f"own{r.randrange(10**9)}" for _ in range(r.randrange(0, 90)))
            out += [" ".join([own(), passage, own()]).strip() for _ in range(2 + k % 2)]
    blanks = [f"w{r.randrange(10**9)}" for _ in range(51)]
    out += ["start " + " ".join(blanks), "other\n" + "\n".join(blanks) + " end", "x" + "z" * 450 + " a", "y" + "z" * 450 + " b", "p q " * 60, "copy of few words", "copy of few words"]
    got = {x.doc_id: x.text for x in corpus_pipeline.cut_passages(spark, make(out), "").collect()}
    want = brute_words(out)
    assert [(k, got[k], want[k]) for k in range(len(out)) if got[k] != want[k]] == []
    assert sum(a != b for a, b in zip(out, want, strict=True)) > 40


def planted(seed, count=40):
    r = random.Random(seed)
    shared = words(300, seed)
    return [words(r.randrange(20, 120), seed + k) + shared[(a := r.randrange(600)) : a + r.randrange(300, 900)] + words(r.randrange(20, 90), seed - k) for k in range(count)]


def test_hot_names_divide_into_the_same_result(make, monkeypatch):
    """Classes far above the bound fold, halve and halve again; results stay those of brute force."""
    monkeypatch.setattr(passages, "CLASS", 3)
    monkeypatch.setattr(passages, "SIDE", 50)
    t = [*planted(5), *texts(4), *["k" * n for n in (2700, 1500, 401, 400)], "own" + "xyz" * 700 + "end", "other" + "zxy" * 500, "k" * 2000 + planted(9, 1)[0], "m " * 900]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in passages.digests(make(t)).collect()}
    assert [k for k, b in enumerate(brute(t)) if got[k] != b] == []
    got = {x.doc_id: x.text for x in passages.without_passages(make(t), cuts=(passages.BYTES, passages.WORDS)).collect()}
    assert [k for k, b in enumerate(brute_words(t)) if (got[k] or "") != b and "\ufffd" not in b] == []


def test_blocks_of_a_text_make_no_difference(monkeypatch):
    raw = (words(4000, 8) + " " + "x" * 3000 + " " + words(2000, 9)).encode()
    whole = [passages.Texts([raw, b"", raw[:3000]], cut).named() for cut in (passages.BYTES, passages.WORDS)]
    monkeypatch.setattr(passages, "BLOCK", 7777)
    parts = [passages.Texts([raw, b"", raw[:3000]], cut).named() for cut in (passages.BYTES, passages.WORDS)]
    # blocks thin stretches of a short period apart from each other, so more anchors may stay there
    assert all(set(zip(*(z.tolist() for z in x[:3]), strict=True)) <= set(zip(*(z.tolist() for z in y[:3]), strict=True)) for x, y in zip(whole, parts, strict=True))
    few = units.words(raw)[0]
    monkeypatch.setattr(units, "BLOCK", 500)
    monkeypatch.setattr(units, "POWERS", units.powers(units.BASE))
    monkeypatch.setattr(units, "INVERSE", units.powers(pow(units.BASE, -1, 2**64)))
    assert np.array_equal(units.words(raw)[0], few)


def test_a_run_of_one_letter_takes_few_tuples():
    """Twice the run, about as many tuples that go to others."""
    counts = []
    for n in (20_000, 40_000):
        x = passages.Texts([b"a" * n], passages.BYTES)
        counts.append(sum(r[1].drop_null().__len__() for r in passages.tuple_columns(x, x.named()[1])))
    assert counts[0] == counts[1] < 600
    # neither do they take memory: inner anchors go block by block
    assert max(len(passages.Texts([x * 200_000], passages.BYTES).named()[0]) for x in (b"a", b"ab", b"abc")) < 6000
