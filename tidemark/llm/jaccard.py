"""Exact Jaccard join of documents' word shingle sets as a metric-space join, reduced to classes and components.

1. Equal sets are one node, so copies never meet as pairs.
2. Regions: of two sets with a similarity of at least 80 %, the first n // 9 + 1 shingles of the smaller and the first n // 5 + 1 of the
   larger one share a shingle in any common order, so each shingle that is among the former of one set (its core) and the latter of another
   spans a region, and every link lies in one, with its smaller set in the core. The order puts frequent shingles last (a sketch of their
   counts says which; it changes the work, not the result), so texts of one template meet in a region only if they are nearly similar.
   Regions with the same members count once. Frequent shingles are counted by partial aggregates, so none is gathered in a task.
3. Each region's pivot is its smallest node. Members are compared with the pivot; those within the radius join its ball, and components
   of the links found so far need no further comparison inside. Regions that still hold several components take their member nearest to
   the pivot as second pivot and compare again.
4. What is left joins by triangle-inequality windows, recursively: bitmaps of the sets under Hamming distance are a metric space, and
   linked sets' distances to a pivot differ by at most a ninth of their sizes' sum. A cell (region and size class) that is not small takes
   a pivot of its own and is divided into windows of distance; core members are replicated to the neighbouring windows, so every link
   meets. Its parts are cells in turn, until they are small or keep over half of the work of the cell they come from; those are compared
   in blocks of bounded size. Pairs of one component are left out.

A pair is first held against the bitmaps (their distance is at most that of the sets), then decided by its sets, from whole texts.

A set: distinct 5-word shingles, A-Z lower case, words between ASCII white space; with fewer words the whole sequence is one shingle.
Null texts and texts without words: an empty set, linked with nothing, component_id its own id. Repeated rows are copies. Null ids take
part; a component's id is its smallest id that is not null. Rows with one id or none are told apart by their texts (``row_key``).
Shingles, sets and row keys compare by 64-bit hashes.
"""

from __future__ import annotations

import functools
import hashlib
from collections import OrderedDict

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, units

SHINGLE, CACHE = 5, 300_000
#: Buckets of the sketch of shingle counts; a task reports buckets this far beyond what chance would put there.
BUCKETS, SURPRISE = 1 << 20, 6.0
#: Bits of the smallest bitmaps, to which all fold for the comparison inside windows.
SKETCH = 1024
#: Comparisons that a cell may cost without being divided, and members of either side in a block of one that can't be divided.
SMALL, BLOCK = 10_000, 2048
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def sets_of(texts: list[str | None]) -> list[np.ndarray]:
    """Texts' sets as sorted arrays of 64-bit hashes."""
    x, _, _, begin, end = units.words_of([(t or "").encode() for t in texts], lower=True)
    h = hashes(x, SHINGLE)
    out = []
    for i, j in zip(begin.tolist(), end.tolist(), strict=True):
        s = np.sort(h[i : j - SHINGLE + 1] if j - i >= SHINGLE else hashes(x[i:j], max(1, j - i)))
        out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) else s)
    return out


def hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Of each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h += words[k : n + k] * MULTIPLIERS[k]
        h ^= h >> np.uint64(29)
    h *= MULTIPLIERS[1]
    h ^= h >> np.uint64(32)
    return h


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit a hash, one to two bits of room for each; sizes are powers of two, so a larger one folds onto a smaller."""
    bits = max(SKETCH, 1 << min(16, int(len(shingles) - 1).bit_length()))
    out = np.zeros(bits, np.uint8)
    out[(shingles >> np.uint64(40)) & np.uint64(bits - 1)] = 1
    return np.packbits(out).tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two bitmaps, at the smaller one's size."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(z.reshape(-1, size), 0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def folded(bits: bytes) -> list[int]:
    """A bitmap at SKETCH bits, as whole numbers that SQL can compare."""
    return np.bitwise_or.reduce(np.frombuffer(bits, np.uint8).reshape(-1, SKETCH // 8), 0).view(np.int64).tolist()


def row_key(key: Column, text: Column) -> Column:
    """A row's key: rows that share it have one id and one text, so any of them stands for all."""
    return F.xxhash64(key, text)


#: A row's summary, or a bucket of the sketch with its count.
SUMMARY = {"doc_id": "long", "at": "long", "node": "long", "n_shingles": "long", "bits": "binary", "bucket": "long", "n": "long"}


def summaries(docs: DataFrame) -> DataFrame:
    """SUMMARY: doc_id, at (row_key), node, n_shingles, bits for each row; node and bits are null for empty sets. At the end of each task, the
    buckets of shingles that it found frequent."""
    common.find_package(docs.sparkSession)

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, common.OUT_ROWS):
                part = b.slice(at, common.OUT_ROWS)
                ids, keys, texts = (c.to_pylist() for c in part.columns)
                sets = sets_of(texts)
                if sets:
                    counts += np.bincount((np.concatenate(sets) & np.uint64(BUCKETS - 1)).view(np.int64), minlength=BUCKETS)
                none = [None] * len(sets)
                yield common.batch(SUMMARY, [ids, keys, [node_of(s) if len(s) else None for s in sets], [len(s) for s in sets], [bitmap(s) if len(s) else None for s in sets], none, none])
        mean = counts.mean()
        high = np.flatnonzero(counts > mean + SURPRISE * np.sqrt(mean) + SURPRISE)
        none = [None] * len(high)
        yield common.batch(SUMMARY, [none, none, none, none, none, high, counts[high]])

    return docs.select("doc_id", "at", "text").mapInArrow(run, common.ddl(SUMMARY))


def frequent(told: DataFrame) -> np.ndarray:
    """Which of BUCKETS buckets of shingles hold frequent ones: a sketch of fixed size, from counts of all documents."""
    out = np.zeros(BUCKETS, bool)
    out[[r["bucket"] for r in told.filter("bucket is not null").select("bucket").distinct().collect()]] = True  # at most BUCKETS rows
    return out


def first_shingles(docs: DataFrame, late: np.ndarray, hot: bool) -> DataFrame:
    """shingle, node, core: the first n // 5 + 1 shingles of each set, frequent ones last, and whether they are of the first n // 9 + 1. Only
    the frequent ones if hot, otherwise only the others."""
    schema = {"shingle": "long", "node": "long", "core": "boolean"}
    packed = np.packbits(late)

    def make():
        last, told = np.unpackbits(packed).astype(bool), set()

        def f(texts):
            tokens, nodes, core = [], [], []
            for s in sets_of(texts):
                node = node_of(s)
                # a task tells of a set once, as far as it remembers
                if len(s) and node not in told:
                    heavy = last[s & np.uint64(BUCKETS - 1)]
                    first, light = len(s) // 5 + 1, len(s) - int(heavy.sum())
                    some = s[heavy][: max(0, first - light)] if hot else s[~heavy][:first]
                    tokens.append(some.view(np.int64))
                    nodes.append(np.full(len(some), node, np.int64))
                    core.append(np.arange(len(some)) + (light if hot else 0) <= len(s) // 9)
                    if len(told) >= CACHE:
                        told.clear()
                    told.add(node)
            return [np.concatenate(x) if x else [] for x in (tokens, nodes, core)]

        return f

    return common.map_rows(docs, ["text"], schema, make)


def regions(docs: DataFrame, late: np.ndarray) -> DataFrame:
    """region, pivot, node, core: members of each shingle that is in the core of one set and among the first ones of another; regions with
    the same members count once, core is true where one of their shingles says so."""
    marks = {"low": F.min("node"), "high": F.max("node"), "mix": F.bit_xor("node"), "n": F.count("node"), "sum": F.sum(F.hash("node").cast("long")), "cored": F.max("core")}
    same = Window.partitionBy("shingle")
    light = first_shingles(docs, late, hot=False).select("node", "core", *(m.over(same).alias(k) for k, m in marks.items())).filter("cored and low <> high")
    # frequent shingles: no task gets all rows of one
    hot = common.written(first_shingles(docs, late, hot=True).distinct())
    shared = hot.groupBy("shingle").agg(*(m.alias(k) for k, m in marks.items())).filter("cored and low <> high")
    marked = light.unionByName(hot.join(shared, "shingle").select(light.columns))
    return marked.groupBy(F.xxhash64("low", "high", "mix", "n", "sum").alias("region"), F.col("low").alias("pivot"), "node").agg(F.max("core").alias("core"))


def near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b and other columns, with na, nb and their bitmaps' distance h, of pairs that the bitmaps don't rule out (`possible`)."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("bits_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("bits_b")), "b")
    schema = {"a": "long", "b": "long", "na": "long", "nb": "long", "h": "long", "possible": "boolean"}

    def make():
        def f(a, b, na, nb, x, y):
            h = [distance(p, q) for p, q in zip(x, y, strict=True)]
            # similarity >= 4/5: the sets differ in at most a ninth of their sizes' sum
            return [a, b, na, nb, h, [9 * d <= m + n and 5 * min(m, n) >= 4 * max(m, n) for d, m, n in zip(h, na, nb, strict=True)]]

        return f

    return common.map_rows(both, ["a", "b", "na", "nb", "bits_a", "bits_b"], schema, make)


def texts_of(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text of the nodes in pairs, one row each: other texts are not dealt out."""
    some = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = common.written(docs.join(sets.select("at", "node", "times").join(some, "node"), "at").select("node", "text", "times"))
    return texts.filter("times = 1").select("node", "text").union(texts.filter("times > 1").groupBy("node").agg(F.first("text").alias("text")))


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b of the pairs whose sets are similar, decided by the sets themselves."""
    both = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def make():
        kept: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(node, text):
            if (s := kept.get(node)) is None:
                (s,) = sets_of([text])
                kept[node] = s
                if len(kept) > 64:
                    kept.popitem(last=False)
            return s

        def f(a, b, ta, tb):
            out = []
            for x, y, s, t in zip(a, b, ta, tb, strict=True):
                u, v = set_of(x, s), set_of(y, t)
                common_part = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * common_part >= 80 * (len(u) + len(v) - common_part):
                    out.append((x, y))
            return [[x for x, _ in out], [y for _, y in out]]

        return f

    return common.map_rows(both, ["a", "b", "ta", "tb"], {"a": "long", "b": "long"}, make)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that links reach, for each node with links. Labels spread to neighbours and jump to their label's
    label until nothing changes; each round is written."""
    ways = common.written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = common.written(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        heard = ways.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("heard"))
        lower = labels.join(heard, "node").select("node", F.col("root").alias("was"), F.least("root", "heard").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = common.written(lower.join(jump, "root", "left").select("node", "was", F.least("root", F.coalesce("far", "root")).alias("root")))
        labels = step.select("node", "root")
        if step.filter("root <> was").limit(1).count() == 0:
            return labels


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, of regions that hold more than one component."""
    told = members.join(labels, "node", "left").select("*", F.coalesce("root", "node").alias("component")).drop("root")
    mixed = told.groupBy("region").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 <> c2").select("region")
    return told.join(mixed, "region")


def cells(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts, sizes): members dealt out so that those who may link meet in exactly one cell, recursively.

    members: region, node, component, core, n (set size), h (distance to the region's pivot), hn (the bitmaps' size there), sketch
    (``folded``). parts: cell, left (core members stand left of all members of at least their size), and members' columns; sizes: cell,
    nl, nr (rows of either side). Each round divides cells that cost over SMALL comparisons and halve at least, so rounds are at most the
    logarithm of the largest region's comparisons.
    """
    # a larger partner has at most 5/4 of the size: it is in the same class or the next
    classed = members.withColumn("above", F.explode(F.expr("if(core, array(-1, 0, 1), array(-1))")))
    parts = classed.select(
        F.xxhash64("region", F.length(F.bin("n")) + F.greatest("above", F.lit(0))).alias("cell"), (F.col("above") >= 0).alias("left"), "node", "component", "n", "h", "hn", "sketch", F.lit(None).cast("double").alias("was"),
    )
    done, counted = [], []
    while True:
        parts = common.written(parts)
        told = parts.groupBy("cell").agg(
            F.count_if("left").cast("double").alias("nl"), F.count_if(~F.col("left")).cast("double").alias("nr"), F.max("was").alias("was"), F.min("component").alias("c1"), F.max("component").alias("c2"),
            F.greatest(F.lit(1.0), F.max("n") * 2 / 9).alias("step"), F.min(F.when(F.col("left"), F.col("node"))).alias("pivot"),
        )
        told = common.written(told.filter("nl > 0 and nr > 0 and c1 <> c2").withColumn("divide", F.expr(f"nl * nr > {SMALL} and (was is null or 2 * nl * nr <= was)")))
        ready = told.filter("not divide")
        done.append(parts.drop("was").join(ready.select("cell"), "cell", "left_semi"))
        counted.append(ready.select("cell", "nl", "nr"))
        if told.filter("divide").limit(1).count() == 0:
            break
        pivots = parts.filter("left").join(told.filter("divide").select("cell", F.col("pivot").alias("node"), "step", (F.col("nl") * F.col("nr")).alias("work")), ["cell", "node"])
        pivots = pivots.groupBy("cell").agg(F.first("sketch").alias("at"), F.first("step").alias("step"), F.first("work").alias("work"))
        far = F.expr("aggregate(zip_with(sketch, at, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)")
        placed = parts.drop("was").join(pivots, "cell").withColumn("place", F.floor(far / F.col("step")).cast("long"))
        # core members go to the neighbouring windows too
        placed = placed.withColumn("k", F.explode(F.expr("if(left, array(-1, 0, 1), array(0))")))
        parts = placed.select(F.xxhash64("cell", F.col("place") + F.col("k")).alias("cell"), "left", "node", "component", "n", "h", "hn", "sketch", F.col("work").alias("was"))
    union = lambda tables: functools.reduce(DataFrame.unionByName, tables)
    return union(done), union(counted)


def windows(members: DataFrame) -> DataFrame:
    """a, b: pairs that share a cell, of different components, whose sizes, distances to pivots and sketches allow a link; a < b. Sides of
    more than BLOCK members are compared block by block, so no task gets all of a cell."""
    parts, sizes = cells(members)
    dealt = parts.join(sizes, "cell").select("*", F.ceil(F.col("nl") / BLOCK).cast("int").alias("p"), F.ceil(F.col("nr") / BLOCK).cast("int").alias("q"))
    own = F.pmod(F.hash("node"), F.when(F.col("left"), F.col("p")).otherwise(F.col("q")))
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, if(left, q, p) - 1)")))
    # keyed by cell, block of the left side, block of the right side
    side = lambda x, left, i, j: dealt.filter(F.col("left") == left).select("cell", F.col(i).alias("i"), F.col(j).alias("j"), F.col("node").alias(x), F.col("component").alias(f"c{x}"), F.col("n").cast("int").alias(f"n{x}"), F.col("h").cast("int").alias(f"h{x}"), F.col("hn").alias(f"r{x}"), F.col("sketch").alias(f"s{x}"))
    l, r = side("a", True, "own", "other").alias("l"), side("b", False, "other", "own").alias("r")  # noqa: E741
    keys = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ("cell", "i", "j")]
    allowed = F.expr("a <> b and ca <> cb and na <= nb and 5 * na >= 4 * nb and (ra <> rb or 9 * abs(ha - hb) <= na + nb)")
    apart_bits = F.expr("9 * aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x) <= na + nb")
    return l.join(r, [*keys, allowed, apart_bits]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, node, root (the component's smallest node), at (row_key) for each row."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    docs = df.select(key.alias("doc_id"), row_key(key, text).alias("at"), text.alias("text"))
    told = common.written(summaries(docs))
    rows = told.filter("bucket is null").drop("bucket", "n")
    members = common.written(regions(docs, frequent(told)))
    some = members.select("node").distinct()
    # one row a node: copies fold before anything is joined
    first_rows = rows.filter("node is not null").groupBy("node").agg(F.min("at").alias("at")).join(some, "node", "left_semi")
    sets = first_rows.join(rows.select("node", "at", "n_shingles", "bits"), ["node", "at"])
    sets = common.written(sets.groupBy("node", "at").agg(F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"), F.count("*").alias("times")))

    first = common.written(near(members.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), sets))
    labels = None
    edges: list[DataFrame] = []
    edges.append(common.written(links(maybe := first.filter("possible"), texts_of(maybe, sets, docs))))
    labels = components(edges[0])

    left = apart(members, labels)
    to_pivot = first.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "h", F.least("na", "nb").alias("smaller"))
    left = common.written(left.join(to_pivot, ["node", "pivot"], "left").withColumn("h", F.coalesce("h", F.lit(0))))
    second = left.filter("node <> pivot").groupBy("region").agg(F.min_by(F.struct("node", "component"), F.struct("h", "node")).alias("s"))
    told = common.written(left.join(second, "region").filter("node <> s.node and node <> pivot"))
    again = told.filter("component <> s.component").select(F.col("node").alias("a"), F.col("s.node").alias("b")).distinct()
    maybe = common.written(near(again, sets).filter("possible"))
    edges.append(common.written(links(maybe, texts_of(maybe, sets, docs))))
    labels = components(edges[0].union(edges[1]))

    # both pivots of a region have met all its members: what is left are the others, where they are of several components
    rest = apart(told.drop("component", "s"), labels).join(sets.select("node", F.col("n_shingles").alias("n"), F.octet_length("bits").alias("room")), "node")
    rest = rest.join(sets.select(F.col("node").alias("pivot"), F.octet_length("bits").alias("pivot_room")), "pivot")
    # distances of bitmaps compare at one size only: that of the smaller of the member and the pivot
    rest = common.written(rest.select("region", "node", "component", "core", "n", "h", F.least("room", "pivot_room").alias("hn")))
    sketches = common.map_rows(sets.join(rest.select("node").distinct(), "node", "left_semi"), ["node", "bits"], {"node": "long", "sketch": "array<long>"}, lambda: lambda n, b: [n, [folded(x) for x in b]])
    pairs = windows(rest.join(sketches, "node"))
    maybe = common.written(near(pairs, sets).filter("possible"))
    edges.append(common.written(links(maybe, texts_of(maybe, sets, docs))))
    labels = components(edges[0].union(edges[1]).union(edges[2]))

    told = rows.join(labels, "node", "left").select("doc_id", "n_shingles", "node", "at", F.coalesce("root", "node").alias("root"))
    smallest = told.groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return told.join(smallest, "root", "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"), "node", "root", "at")


def digests(df: DataFrame) -> DataFrame:
    return classes(df).select("doc_id", "n_shingles", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each component: one whose id is the component's. Rows without words are in no component: of those with one id
    and text one stays, those without id stay all."""
    with common.scratch(df.sparkSession):
        stays = common.written(kept_rows(classes(df, id_col, text_col)), keep=True)
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    bare = key.isNull() & F.coalesce(text.rlike(r"\A[ \t\n\x0B\f\r]*\z"), F.lit(True))
    # repeats of one id and text fold where they are read
    kept = df.filter(~bare).withColumn("__at", row_key(key, text)).dropDuplicates(["__at"]).join(stays, F.col("__at") == F.col("__kept"), "left_semi").drop("__at")
    return kept.unionByName(df.filter(bare))


def kept_rows(told: DataFrame) -> DataFrame:
    """__kept: keys of the rows with ids or words that one_of_each keeps."""
    best = told.filter("node is not null").groupBy("root").agg(F.min_by("at", F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("__kept")).select("__kept")
    return best.union(told.filter("node is null and doc_id is not null").select("at").distinct())
