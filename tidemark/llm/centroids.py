"""Centroid clustering with heap-ordered bounds: each cluster keeps a heap of upper-lower gaps, offset by the drift that has come together.

A vector's gap is a lower bound of its distance to every other centroid, less an upper bound of that to its own. When centroids move, the
gaps of a cluster shrink by at most its own centroid's step and the longest step of another one; instead of touching its vectors, each
cluster adds up these steps. A vector is filed under its gap plus the sum at that time (``key``), and it expires when the sum reaches its
key. Only then can another centroid be nearer, and the vector is scanned against all of them.

The heaps lie on disk, as vectors may be any number. A round's scanned vectors are written as one run, in their own partitions, each sorted
by cluster and key, with the vectors themselves: popping a cluster's heap is reading the range of keys between its last sum and the new one,
and the statistics of row groups leave the rest unread. Sums only grow, so a run's vectors with lower keys are known to have been popped
already, and nothing is ever marked or moved. Vectors are never shuffled; a cluster with a third of all vectors is no key of any exchange.
Centroids follow from the vectors that changed places: each task adds them up, Spark adds up the tasks, and the driver gets one row a
centroid and component.

Arithmetic is in whole numbers; bounds are floating point, rounded so that a vector expires too early rather than too late. Components are
``floor(scale * x)``, held within 2**27 either way so that squared distances fit. Ties go to the smaller number of centroid.

Vectors that are null, of another length, or with null or non-finite components are left out. Null ids are kept, and so are repeated rows.
Fewer vectors than centroids: as many centroids as vectors. An empty table gives no rows, and other columns play no part.
"""

from __future__ import annotations

import functools
import hashlib
import json
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CLUSTERS, ROUNDS, SIZE, SCALE, SEED = 40, 5, 64, 256, 2
LIMIT = 2.0**27
#: Below this magnitude sums of products are exact in double precision, which numpy multiplies fastest.
EXACT = 2**20
RUN = {"vec_id": "long", "v": "array<long>", "was": "int", "cluster": "int", "key": "double"}
#: What rounding may add to a sum of square roots, as a share.
ROUNDING = 1e-9


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id, v: whole components of the vectors that are kept."""
    v = F.col(f"`{vector_col}`")
    good = (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(LIMIT)), F.lit(-LIMIT))))
    return df.filter(good).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), whole.alias("v"))


def matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each vector to each centroid, exact."""
    small = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT
    x, c = (v.astype(np.float64), centroids.astype(np.float64)) if small else (v, centroids)
    return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)


def scanned(rows: DataFrame, centroids: np.ndarray, sums: np.ndarray) -> DataFrame:
    """Vectors (vec_id, v, was) against all centroids: a run of the heaps."""
    common.find_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = distances(matrix(b.column(1)), centroids)
            nearest = d.argmin(1)
            at = np.arange(len(d))
            own = np.sqrt(d[at, nearest].astype(np.float64))
            others = d.astype(np.float64)
            others[at, nearest] = np.inf
            second = np.sqrt(others.min(1))
            slack = ROUNDING * (1 + own + np.where(np.isinf(second), 0, second) + sums[nearest])
            yield common.batch(RUN, [b.column(0), b.column(1), b.column(2), pa.array(nearest.astype(np.int32)), pa.array(second - own + sums[nearest] - slack)])

    return rows.select("vec_id", "v", "was").mapInArrow(run, common.ddl(RUN)).sortWithinPartitions("cluster", "key")


def moved(run: DataFrame, k: int, size: int) -> np.ndarray:
    """Changes of each cluster's sums and, in the last column, of its count. A task gives one row for each number that isn't zero."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for b in batches:
            v = np.hstack([matrix(b.column(0)), np.ones((b.num_rows, 1), np.int64)]) if b.num_rows else np.zeros((0, size + 1), np.int64)
            was, now = (np.asarray(b.column(c)) for c in (1, 2))
            np.add.at(total, now, v)
            np.subtract.at(total, was[was >= 0], v[was >= 0])
        cluster, part = np.nonzero(total)
        if len(cluster):
            yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(part), pa.array(total[cluster, part])], names=["cluster", "part", "total"])

    out = np.zeros((k, size + 1), np.int64)
    told = run.filter("was <> cluster").select("v", "was", "cluster").mapInArrow(add, "cluster long, part long, total long")
    for r in told.groupBy("cluster", "part").agg(F.sum("total").alias("total")).collect():  # k * (size + 1) rows at most
        out[r["cluster"], r["part"]] = r["total"]
    return out


class Heaps:
    """The runs, each with the sums up to which it has been popped, and how many vectors were scanned in each round."""

    def __init__(self, k: int) -> None:
        self.sums = np.zeros(k)
        self.runs: list[tuple[DataFrame, np.ndarray | None]] = []

    @staticmethod
    def between(low: np.ndarray | None, high: np.ndarray | None, k: int):
        """Rows of each cluster with keys above low and up to high; plain comparisons, which reach the files' statistics."""
        one = lambda j: functools.reduce(operator.and_, [F.col("cluster") == j, *([F.col("key") > float(low[j])] if low is not None else []), *([F.col("key") <= float(high[j])] if high is not None else [])])
        terms = [one(j) for j in range(k)]
        while len(terms) > 1:  # a flat tree
            terms = [functools.reduce(operator.or_, terms[i : i + 2]) for i in range(0, len(terms), 2)]
        return terms[0]

    def grow(self, old: np.ndarray, new: np.ndarray) -> None:
        """Adds each cluster's drift: its own step and the longest one of the others."""
        step = np.sqrt(((new - old).astype(np.float64) ** 2).sum(1))
        order = np.argsort(step)
        longest = np.full(len(step), step[order[-1]])
        longest[order[-1]] = step[order[-2]] if len(step) > 1 else 0
        self.sums = (self.sums + step + longest) * (1 + ROUNDING)

    def pop(self) -> DataFrame:
        """The vectors that have expired. They are gone from then on."""
        k = len(self.sums)
        out = [run.filter(self.between(low, self.sums, k)).select("vec_id", "v", F.col("cluster").alias("was")) for run, low in self.runs]
        self.runs = [(run, self.sums.copy()) for run, _ in self.runs]
        return functools.reduce(DataFrame.unionByName, out)

    def left(self) -> DataFrame:
        """All vectors, each as last scanned."""
        k = len(self.sums)
        return functools.reduce(DataFrame.unionByName, [(run if low is None else run.filter(self.between(low, None, k))).select("vec_id", "v", "cluster") for run, low in self.runs])


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids' hashes are lowest: k rows."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in kept.withColumn("hash", named).orderBy("hash", "v").limit(k).collect()], np.int64)


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED, told: list | None = None) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256. ``told`` gets the number of vectors scanned in each
    round."""
    spark = df.sparkSession
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kept = vectors(df, id_col, vector_col, size, scale)
    centroids = first_centroids(kept, k, seed)
    if not (k := len(centroids)):
        return spark.createDataFrame([], out)
    with common.scratch(spark):
        heaps, totals = Heaps(k), np.zeros((k, size + 1), np.int64)
        for step in range(rounds + 1):
            popped = heaps.pop() if step else kept.withColumn("was", F.lit(-1))
            run = common.written(scanned(popped, centroids, heaps.sums))
            heaps.runs.append((run, None))
            if told is not None:
                told.append(run.count())
            if step == rounds:
                break
            totals += moved(run, k, size)
            n = totals[:, -1:]
            new = np.where(n > 0, totals[:, :-1] // np.maximum(n, 1), centroids)
            if (new == centroids).all():  # nothing moves any more
                break
            heaps.grow(centroids, new)
            centroids = new
        made = [(j, c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
        known = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps([{"c": j, "at": c, "h": h} for j, c, h in made])), "array<struct<c: int, at: array<bigint>, h: string>>")).alias("m")).select("m.*")
        squares = F.aggregate(F.zip_with("v", "at", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda a, b: a + b)
        placed = common.written(heaps.left().join(F.broadcast(known), F.col("cluster") == F.col("c")).select("vec_id", "cluster", squares.alias("distance")), keep=True)
    of = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # k rows
    fits = lambda x: x if x < 2**63 else None
    facts = spark.createDataFrame([(j, fits(of.get(j, 0)), fits(sum(of.values())), h) for j, _, h in made], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle() -> str:
    """The same in plain Lloyd rounds, spelt out."""
    nearest = "SELECT v.id, any_value(v.vec_id) AS vec_id, any_value(v.q) AS q, min({'d': list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c.c}) AS near FROM v, %s c GROUP BY v.id"
    steps = [
        "v AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings"
        " WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64)",
        f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, q FROM (SELECT sha256('{SEED}:' || vec_id) AS h, q FROM v ORDER BY h LIMIT {CLUSTERS}))",
    ]
    for r in range(ROUNDS):
        # the quotient of whole numbers is cut towards zero: the remainder is taken off first
        mean = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
        steps.append(f"a{r} AS ({nearest % f'c{r}'})")
        steps.append(
            f"m{r} AS (SELECT c, list(m ORDER BY i) AS q FROM (SELECT c, i, {mean} AS m FROM (SELECT near.c AS c, unnest(q) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY c, i) GROUP BY c),"
            f" c{r + 1} AS (SELECT c{r}.c, coalesce(m{r}.q, c{r}.q) AS q FROM c{r} LEFT JOIN m{r} ON m{r}.c = c{r}.c)"
        )
    return f"""WITH {", ".join(steps)}, z AS ({nearest % f"c{ROUNDS}"})
SELECT z.vec_id, near.c AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM z JOIN c{ROUNDS} c ON c.c = near.c"""
