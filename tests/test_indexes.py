"""Pages, search and neighbourhoods read what they need, and give what a scan gives."""

import random

from pyspark.sql import functions as F

from tidemark.operators import graph, resolve
from tidemark.operators.paging import Pages
from tidemark.operators.search import TextIndex


def test_pages(spark):
    r = random.Random(1)
    rows = [(r.choice([None, r.randrange(40)]), k) for k in range(1003)]
    df = spark.createDataFrame(rows, "v int, k long").repartition(5)
    pages = Pages(df, [F.col("v").desc_nulls_last(), F.col("k")])
    want = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert pages.total == 1003 and pages.last(100) == 11
    for number in (1, 2, 5, 10, 11):
        assert [tuple(x) for x in pages.page(number).collect()] == want[100 * (number - 1) : 100 * number]
    assert [tuple(x) for x in pages.page(99).collect()] == want[1000:] and [tuple(x) for x in pages.page(-3, 7).collect()] == want[:7]
    # the ranges that hold the page are told by name, places inside them reach the files
    plan = pages.page(3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__block" in plan.split("PartitionFilters")[1].split("]")[0] and "LessThan(__row" in plan
    assert Pages(df.limit(0), [F.col("k")]).page(4).collect() == []


def test_search_gives_a_scans_rows(spark):
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcdé ñ") for _ in range(r.randrange(1, 9))) for _ in range(30)) for _ in range(300)] + [None, "", "ab", "ABC"]
    df = spark.createDataFrame([(k % 290 if k != 7 else None, t, "tag" if k % 3 else None) for k, t in enumerate(texts)], "id long, t string, tag string")
    index = TextIndex(df, "id", ["tag", "t"], parts=8)
    fold = lambda s: s.lower().replace("é", "e").replace("ñ", "n")
    for asked in ("abc", "ÁBCD dé", "tag abca", "b", "zzz", "", "ab cab", "eee nnn"):
        want = sorted(str(k % 290 if k != 7 else None) for k, t in enumerate(texts) if all(fold(w).replace("á", "a") in fold(" ".join(x for x in ("tag" if k % 3 else None, t) if x is not None)) for w in asked.split()))
        assert sorted(str(x.id) for x in index.search(asked).collect()) == want, asked
    assert index.candidates(["ab"]) is None
    few = index.candidates(["abcda"])
    assert few.count() < 300 and "bucket" in few._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]


def test_a_new_server_feeds_the_next_level(spark):
    rows = spark.createDataFrame([(1, "s1", "d", "t"), (2, "new", "d", "t"), (3, None, "d", "t"), (4, "s1", "x", "t"), (5, "s1", "d", "old"), (6, "also", None, None)], "k long, s string, d string, t string")
    servers = spark.createDataFrame([("s1", 4)], "name string, sid long")
    dbs = spark.createDataFrame([("d", 10, 4)], "db string, did long, up long")
    tabs = spark.createDataFrame([("t", 100, 10, True), ("old", 101, 10, False)], "tab string, tid long, up2 long, live boolean")
    told, members = resolve.created_chain(rows, ("s", servers, "name", "sid"), [("d", dbs, "db", "did", "up", None), ("t", tabs, "tab", "tid", "up2", "live")])
    got = {r.k: (r.sid, r.did, r.tid, r.failed_level, r.reason) for r in told.collect()}
    assert got == {1: (4, 10, 100, None, None), 2: (6, None, None, "d", "unknown"), 3: (None, None, None, "s", "unknown"), 4: (4, None, None, "d", "unknown"), 5: (4, 10, 101, "t", "inactive"), 6: (5, None, None, "d", "unknown")}
    assert sorted((r.sid, r.name, r.created) for r in members.collect()) == [(4, "s1", False), (5, "also", True), (6, "new", True)]


def test_one_domain_reads_its_folder(spark):
    edges = spark.createDataFrame([(1, 2, "a", 3), (2, 1, "a", 5), (1, 3, "b", 1), (3, 2, "a", 9)], "origin long, target long, type string, n long")
    links = spark.createDataFrame([(10, 1, 20, 2, "RESOLVED"), (11, 1, None, None, "NO_LINK"), (12, 2, 10, 1, "RESOLVED")], "id long, domain_id long, primary_id long, primary_domain_id long, state string")
    near = graph.Neighbourhoods(edges, links)
    assert sorted(tuple(r) for r in near.neighbours(1).collect()) == [(2, 3, 5, 8), (3, 1, 0, 1)] and [tuple(r) for r in near.neighbours(1, 4).collect()] == [(2, 0, 5, 5)]
    assert sorted((r.id, r.priority) for r in near.attributes(1).collect()) == [(10, None), (11, 3)]
    assert near.measures(1).first().asDict() == {"n_declared": 2, "n_drawn": 1, "n_problems": 1, "n_targets": 2, "n_sources": 1, "n_used": 5, "drawn_share": 50.0}
    assert "domain_id" in near.neighbours(1)._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
