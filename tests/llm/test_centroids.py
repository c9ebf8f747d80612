import hashlib
import random

import numpy as np

from tidemark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, key double, v string"


def plain(rows, k, rounds, size, seed=2):
    """Lloyd's rounds over all vectors and all centroids."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(v) for _, v in start]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            c[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, j in found:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(map(str, ((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, d, j in found)))


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 0.5, "x") for i, v in rows], SCHEMA).repartition(parts)


def told(df):
    return sorted(map(str, ((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())))


def test_same_as_plain_rounds(spark):
    r = random.Random(1)
    middle = [[r.uniform(-1, 1) for _ in range(8)] for _ in range(6)]
    rows = [(k, [m + r.gauss(0, 0.1) for m in middle[r.randrange(6)]]) for k in range(600)]
    # ties, repeats, null and bad vectors, a vector that a third of the rows share
    rows += [(k, [0.5] * 8) for k in range(300)] + [(None, [0.25] * 8), (7, None), (8, [1.0] * 7), (9, [1.0] * 7 + [None]), (10, [1.0] * 7 + [float("nan")]), (11, [float("inf")] + [1.0] * 7), (12, [])]
    rows += [(1000 + k, [float(k % 3), float(k % 2)] + [0.0] * 6) for k in range(60)]
    scanned = []
    got = told(centroids.cluster(frame(spark, rows), k=12, rounds=4, size=8, told=scanned))
    assert got == plain(rows, 12, 4, 8)
    assert scanned[0] == 961 and sum(scanned[1:]) < 0.8 * 961 * 4


def test_settled_vectors_are_left_alone(spark):
    r = random.Random(3)
    far = [[100.0 * k] * 4 for k in range(5)]
    rows = [(k, [x + r.random() for x in far[k % 5]]) for k in range(500)]
    scanned = []
    got = told(centroids.cluster(frame(spark, rows), k=5, rounds=8, size=4, told=scanned))
    assert got == plain(rows, 5, 8, 4)
    assert scanned[0] == 500 and min(scanned) < 50


def test_edges(spark):
    rows = [(k, [float(k)] * 4) for k in range(3)]
    assert told(centroids.cluster(frame(spark, rows), k=40, size=4)) == plain(rows, 40, 5, 4)
    assert told(centroids.cluster(frame(spark, rows), k=1, size=4)) == plain(rows, 1, 5, 4)
    assert centroids.cluster(frame(spark, rows).limit(0)).collect() == []
    assert centroids.cluster(frame(spark, rows)).collect() == []  # none has 64 components
    # huge components are held within bounds, and stay exact
    wide = [(k, [3e38 if k % 2 else -3e38, 1e6 * k, 0.0, 1.5]) for k in range(9)]
    got = centroids.cluster(frame(spark, wide), k=2, size=4).collect()
    assert len(got) == 9 and all(x.distance >= 0 for x in got)


def test_pops_are_ranges_that_reach_the_files(spark):
    run = centroids.scanned(centroids.vectors(frame(spark, [(k, [float(k % 7)] * 4) for k in range(50)]), size=4).selectExpr("*", "-1 as was"), np.array([[0] * 4, [1000] * 4]), np.zeros(2))
    heaps = centroids.Heaps(2)
    heaps.runs.append((centroids.common.written(run), None))
    heaps.sums = np.array([100.0, 200.0])
    plan = heaps.pop()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "LessThanOrEqual(key" in plan
