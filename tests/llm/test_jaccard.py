import random
from collections import defaultdict
from itertools import combinations

from tidemark.llm import jaccard

from .conftest import EDGE_IDS, EDGE_TEXTS, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def edited(text, n, r):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def near_copies(seed):
    """Copies with few to many edits around the limit, chains, a passage that many share, and short texts."""
    r = random.Random(seed)
    out, passage = [], words(120, seed)
    for k in range(6):
        base = words(r.choice([60, 150, 300]), seed * 10 + k)
        out.append(base)
        out += [edited(base, r.randrange(0, max(2, len(base.split()) // 25)), r) for _ in range(14)]
        chain = base
        for _ in range(6):
            chain = edited(chain, 2, r)
            out.append(chain)
    out += [words(r.randrange(5, 60), seed + k + 99) + " " + passage for k in range(25)]
    out += ["a b c d", "a b c d", "A B C D", "a b c d e", "a b c d e f", "x", "", None, " \n", "a b c d e f g h i j", "a b c d e f g h i j k"]
    r.shuffle(out)
    return out


def test_equal_to_brute_force(make):
    for seed in (1, 2):
        t = near_copies(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.digests(make(t)).collect()}
        want = brute(t)
        assert [(k, got[k], want[k]) for k in range(len(t)) if got[k] != want[k]] == []


def test_rows(edge, empty):
    got = jaccard.digests(edge).collect()
    assert len(got) == len(EDGE_IDS)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[0] == {(0, 0)} and by[6] == by[7] and by[7] == {(3, 6)} and by[9] == {(len(shingles(EDGE_TEXTS[9])), 9)} and by[None] == {(1, None)}
    assert jaccard.digests(empty).count() == 0


def test_one_of_each(edge, make):
    kept = jaccard.one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [0, 1, 2, 3, None, 5, 6, 8, 9, 11, 12]))
    t = near_copies(3)
    assert sorted(r.doc_id for r in jaccard.one_of_each(make(t)).collect()) == sorted({c for _, c in brute(t)})


def test_bitmap_distance_never_exceeds_the_sets():
    r = random.Random(5)
    for _ in range(50):
        base = words(r.randrange(5, 900), r.random())
        a, b = jaccard.sets_of([base, edited(base, r.randrange(30), r)])
        assert jaccard.distance(jaccard.bitmap(a), jaccard.bitmap(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_rows_without_id_and_ids_with_two_texts(make):
    """Such rows are told apart by their texts: links are the sets' own, and one row of each component stays."""
    r = random.Random(7)
    base = [words(80, 500 + k) for k in range(6)]
    t = [f(b) for b in base for f in (str, lambda x: edited(x, 1, r))] + [words(80, 600 + k) for k in range(4)] + [base[5], base[5], "", None]
    ids = [None, 20, None, 21, None, None, 7, 22, 7, 23, None, None, None, None, 7, 24, None, None, None, None]
    want = []
    for n, root in (b := brute(t)):
        own = [i for i, (_, c) in zip(ids, b, strict=True) if c == root and i is not None]
        want.append((n, min(own, default=None)))
    got = sorted(str((x.doc_id, x.n_shingles, x.component_id)) for x in jaccard.digests(make(t, ids)).collect())
    assert got == sorted(str((i, *w)) for i, w in zip(ids, want, strict=True))
    kept = [(x.doc_id, x.text) for x in jaccard.one_of_each(make(t, ids)).collect()]
    roots = [{b[k][1] for k in range(len(t)) if (ids[k], t[k]) == row} for row in kept]
    assert sorted(min(x) for (_, text), x in zip(kept, roots, strict=True) if text) == sorted({c for k, (_, c) in enumerate(b) if t[k]}) and len(kept) == len({c for _, c in b})
    assert all(i == min((j for j, (_, c) in zip(ids, b, strict=True) if {c} == x and j is not None), default=None) for (i, text), x in zip(kept, roots, strict=True) if text)


def test_cells_divide_recursively(make, monkeypatch):
    """With cells and blocks of a few members, links around the limit are still all found."""
    monkeypatch.setattr(jaccard, "SMALL", 12)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rounds, cells = [], jaccard.cells
    monkeypatch.setattr(jaccard, "cells", lambda m: rounds.append(cells(m)) or rounds[-1])
    r = random.Random(11)
    base = words(200, 11)
    # sizes from 120 to 330 words, a chain, and many edits: balls around two pivots don't cover them
    t = [edited(base, r.randrange(3, 9), r) for _ in range(40)] + [edited(" ".join(base.split()[: r.randrange(150, 200)]), 3, r) for _ in range(40)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.digests(make(t)).collect()}
    assert [got[k] for k in range(len(t))] == brute(t)
    parts, sizes = rounds[0]
    assert max(x.nl for x in sizes.collect()) < 80 and parts.count() > 0


def test_texts_of_one_template_do_not_meet(make):
    """Texts that share 56 of 67 shingles have a similarity of 0.72: the cores leave the template out, so there is nothing to compare."""
    r = random.Random(13)
    template = words(60, 13)
    t = [" ".join([template, *(f"own{r.randrange(10**9)}" for _ in range(11))]) for _ in range(60)]
    t += [edited(x, 0, r) + " end" for x in t[:5]]
    docs = make(t)
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) at")
    late = jaccard.frequent(jaccard.summaries(keyed.coalesce(1)))
    members = jaccard.regions(docs, late).collect()
    assert max(sum(m.region == x for m in members) for x in {m.region for m in members}) == 2
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.digests(docs).collect()}
    assert [got[k] for k in range(len(t))] == brute(t)
