"""Steps whose cost must not grow faster than their input."""

import datetime
import random
import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.operators import diff as D
from tidemark.operators import entities as E
from tidemark.operators import kpi as K
from tidemark.operators import reconcile as R
from tidemark.operators.search import TextIndex
from tidemark.plans import intakes, registry, wholes
from tidemark.streaming import intake as I


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_a_date_makes_its_text_once(spark):
    df = spark.range(3).select(F.concat(F.lit("1/2/20"), F.col("id") + 10).alias("day"), F.lit("Sí").alias("flag"))
    for rule in (C.any_date, C.yes_no):
        told = df.filter(rule(F.col("day"))[1].isNull())
        assert plan(told).count("1/2/20") <= 2, plan(told)


def test_shapes_let_through_all_that_formats_take(spark):
    texts = ["2024-01-02 03:04:05", " 2024-01-02 03:04:05\n", "2024-1-02 03:04:05", "1-2-2024", "01/02/2024", "1/2/2024", "1/2/24", "31/2/2024", "001/2/2024", "-1/2/2024", "+2024-01-02 00:00:00", "-2024-01-02 00:00:00", "+12024-01-02 00:00:00", "1/2/12024", "1/2/+12024", "-", "", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    s = C.text_or_null(F.col("t"))
    plainly = F.coalesce(*(F.try_to_timestamp(s, F.lit(f)) for f in C.DATE_FORMATS)).cast("date")
    value, error = C.any_date(F.col("t"))
    for r in df.select("t", value.cast("string").alias("a"), plainly.cast("string").alias("b"), error.isNull().alias("ok")).collect():
        assert r.a == r.b and r.ok == (r.a is not None or r.t in ("-", "", None)), r
    assert C.shape("d MMM yyyy") is None


def test_facts_without_id_are_dealt_out(spark):
    facts = spark.range(4000).select("id", F.when(F.col("id") < 10, F.col("id")).alias("k"))
    names = spark.range(8).select(F.col("id").alias("n"), F.concat(F.lit("name "), "id").alias("text"), (F.col("id") * 2).alias("twice"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    had = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        told = E.star(facts, [("k", names, "n", "text", "name"), ("k", names, "n", "twice", "twice")])
        assert plan(told).count("Join") == 1
        sizes = [r["count"] for r in told.filter("k is null").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3990 and max(sizes) < 2000
        got = {r.id: (r.name, r.twice) for r in told.filter("id < 12").collect()}
    finally:
        for c, v in had.items():
            spark.conf.set(c, v)
    assert got == {k: (f"name {k}", 2 * k) if k < 8 else (None, None) for k in range(12)}


def test_names_of_a_domain_join_rows_that_are_shuffled_no_more(spark):
    of = lambda rows, schema: spark.createDataFrame(rows, schema)
    attributes = of([(1, k, *([" É "] * len(K.PLAIN))) for k in range(3)], "domain_id long, code long, " + ", ".join(f"{c} string" for c in K.PLAIN))
    domains = of([(1, "\tD", "d", "Activo")], "domain_id long, domain string, domain_name string, state_class string")
    source = "domain_id long, code long, primary boolean, class string, server string, database string, `table` string, field string"
    official = of([(1, 0, True, "c", "S", "b", "t", "ÁF")], source)
    used = of([(1, 2, False, "c", "s", "b", "t", "f")], source)
    people = of([(1, 2, "Ñandú"), (1, 9, "Zoë ")], "domain long, role_id int, name string")
    told = K.wide_rows(attributes, domains, official, used, of([(1, "RESOLVED")], "id long, state string"), people)
    # the join on top is theirs
    assert "strategy=broadcast" in plan(told).split("Join LeftOuter")[1].split("\n")[0]
    for r in told.collect():
        pieces = [r.full_code, r["name"], r.description, r.primary_name, r.primary_domain, r.kind, r.personal_class, r.role_1, r.role_2, r.role_3, r.role_4, r.other_roles, *(r[f"official_{f}"] for f in K.PATH), *(r[f"consumption_{f}"] for f in ("class", *K.PATH))]
        whole = " ".join(p for p in pieces if p)
        assert r.search == "".join(c for c in unicodedata.normalize("NFD", whole) if not unicodedata.combining(c)).lower().strip(), r


def test_lists_of_alike_texts_meet_few_pairs(spark, monkeypatch):
    """Names that all look alike, each with its own spelling in the list: pairs that are scored grow with the names."""
    asked = []
    scored = D.scored_pairs
    monkeypatch.setattr(D, "scored_pairs", lambda met, ratio: asked.append(met.count()) or scored(met, ratio))
    n = 300
    catalogue = [(1, f"Supplier#{k:09d}") for k in range(n)]
    template = [(1, f"SUPPLIER#{k:09d}" if k % 2 else f"Supplier#{k:09d}e", k) for k in range(n)] + [(1, "=?=" + "!@#$%"[k % 5] * (k + 2), n + k) for k in range(40)]
    told = D.compare_lists(spark.createDataFrame(template, "group int, value string, pos long"), spark.createDataFrame(catalogue, "group int, value string")).collect()
    assert {(r.value, r.status, r.partner) for r in told if r.status != "MISSING"} == {(v, "EQUIVALENT" if p % 2 else "TYPO", catalogue[p][1]) for _, v, p in template[:n]}
    assert len(told) == n + 40 and sum(asked) <= 4 * n


def test_partners_as_a_plain_walk_chooses_them(spark):
    """Contested partners: values that lose their best one, and values that lose theirs to those."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(2, 9)))
    template = [(g, v, k) for g in range(6) for k, v in enumerate(dict.fromkeys([word() for _ in range(30)] + [word().upper() for _ in range(10)] + ["abcabc" * 12, "abcabc" * 12 + "a"]))]
    catalogue = [(g, v) for g in range(6) for v in dict.fromkeys([word() for _ in range(20)] + [word().title() for _ in range(10)] + ["Abcabc" * 12 + "b", "x" + "abcabc" * 12])]
    want = set()
    for g in range(6):
        listed, known = [v for h, v, _ in template if h == g], [v for h, v in catalogue if h == g]
        left = sorted(set(known) - set(listed))
        for v in listed:
            if v in known:
                continue
            best = max(((SequenceMatcher(None, p.lower(), v.lower()).ratio(), p.lower(), p) for p in left if p.lower() != v.lower()), default=(0, "", ""))
            same = [p for p in left if p.lower() == v.lower()]
            p = min(same) if same else best[2] if best[0] >= 0.75 else None
            if p:
                left.remove(p)
            want.add((g, v, "EQUIVALENT" if same else "TYPO" if p else "MISSING", p))
        want |= {(g, p, "EXTRA", None) for p in left}
    told = D.compare_lists(spark.createDataFrame(template, "group int, value string, pos long"), spark.createDataFrame(catalogue, "group int, value string")).collect()
    assert {(r.group, r.value, r.status, r.partner) for r in told} == want


def test_an_index_lists_ids_by_run(spark):
    df = spark.range(900).select("id", F.concat(F.lit("common words of all texts "), "id").alias("t")).coalesce(1)
    index = TextIndex(df, "id", ["t"], parts=2)
    assert index.runs.count() < 3000 and index.runs.select(F.sum(F.size("ids"))).first()[0] > 20000
    assert sorted(r.id for r in index.search("COMMON s 89").collect()) == [k for k in range(900) if "89" in str(k)]


def test_sides_that_lie_by_the_base_key_are_paired_where_they_lie(spark):
    rows = spark.range(1000).selectExpr("id % 300 as base", "cast(id % 7 as string) as formula", "id", "date'2024-01-01' as approval_date").repartition(7, "base")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    had = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        told = R.pair_by_formula(rows.filter("id % 3 <> 0"), rows.filter("id % 4 <> 0"), ["base"])
        made = told._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in had.items():
            spark.conf.set(c, v)
    assert made.count("Exchange hashpartitioning") == 2 and made.count("Sort [") == 1, made


def test_pairs_as_a_join_makes_them(spark):
    """Repeated keys, spaces around formulas, missing formulas, dates and keys: as if each side's rows were joined by base and formula key."""
    rng = random.Random(5)
    side = lambda: [(rng.choice([*range(40), None]), rng.choice(["a", " a", "b", "", " ", None]), rng.randrange(9), rng.choice([datetime.date(2024, 1, k) for k in (1, 2, 3)] + [None])) for _ in range(70)]
    old, new = side(), side()
    schema = "base int, formula string, id int, approval_date date"
    got = Counter(tuple(r) for r in R.pair_by_formula(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).drop("id"), ["base"]).collect())
    n_old, n_new = (Counter(r[0] for r in x) for x in (old, new))
    key = lambda r: (r[0], "" if n_old[r[0]] == n_new[r[0]] == 1 else (r[1] or "").strip(" "))
    old, new = [r for r in old if r[0] is not None], [r for r in new if r[0] is not None]
    want = Counter((*key(o), "DELETE", o[2], o[3], None) for o in old if key(o) not in set(map(key, new))) + Counter((*key(n), "INSERT", None, None, n[3]) for n in new if key(n) not in set(map(key, old)))
    for o in old:
        for n in new:
            if key(o) == key(n):
                what = "UPDATE" if None in (o[3], n[3]) or o[3] == n[3] else "REPLACE" if n[3] > o[3] else "SKIP_DATE_REGRESSED"
                want[*key(o), what, o[2], o[3], n[3]] += 1
    assert got == want and {w[2] for w in want} == {"INSERT", "UPDATE", "REPLACE", "DELETE", "SKIP_DATE_REGRESSED"}


def test_a_tasks_share_does_not_grow_with_the_table(spark):
    assert registry.parts(spark.range(10)) == spark.sparkContext.defaultParallelism
    assert registry.parts(spark.range(100 * registry.TASK_ROWS + 1)) == 101


def test_a_submissions_lines_are_read_once_for_its_gates(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    head = '{"control": {"template": "catalogue", "version": "1.2.0"}}'
    rows = ['{"row": {"domain": "A", "code": "%d", "total": "1", "approval_date": "2024-01-01"}}' % k for k in range(3)]
    told = [("a", k, v) for k, v in enumerate([head, *rows])] + [("b", k, v) for k, v in enumerate([head, rows[0], '{"row": {"domain": "A"}}'])] + [("c", 0, head), ("d", 0, "no record")]
    lines = spark.createDataFrame(told, "file string, place long, value string").withColumn("value", F.udf(seen, "string").asNondeterministic()("value"))
    heads = {h["file"]: (h["domain"], h["n_rows"], h["gate"], h["wave"]) for h in intakes.submissions(spark, str(tmp_path)).heads(lines)}
    assert heads == {"a": ("A", 3, "ACCEPTED", 1), "b": ("A", 2, "REJECTED_STRUCTURE", 2), "c": (None, 0, "REJECTED_STRUCTURE", 1), "d": (None, 0, "REJECTED_CONTROL", 1)}
    assert read.value == len(told)


def test_lines_stay_where_they_are_read(spark, tmp_path):
    (tmp_path / "f").write_text("a\nb\n")
    assert "strategy=broadcast" in plan(I.line_places(I.lines_of(spark.read.text(str(tmp_path)))))


def test_sources_lie_by_order_in_parts_of_their_number(spark, monkeypatch):
    monkeypatch.setattr(registry, "TASK_ROWS", 500)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    had = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        made = wholes.entity_orders(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in had.items():
            spark.conf.set(c, v)
    dealt = [line for line in made.split("\n") if "Exchange hashpartitioning(l_orderkey" in line or "Exchange hashpartitioning(code" in line]
    assert len(dealt) == 2 and all("L, 12)" in line for line in dealt), made
    assert "l_extendedprice" not in made


def test_columns_that_nobody_reads_are_not_kept_to_deal_out_rows(spark):
    facts = spark.range(50).select("id", F.when(F.col("id") < 10, F.col("id")).alias("k"), F.concat(F.lit("long "), "id").alias("unread"))
    told = E.star(facts, [("k", spark.range(8).select(F.col("id").alias("n"), F.lit("x").alias("text")), "n", "text", "name")], ("id",)).select("id", "name")
    assert "unread" not in plan(told) and {r.id: r.name for r in told.collect()} == {k: "x" if k < 8 else None for k in range(50)}


def test_small_catalogues_are_broadcast_and_large_ones_are_not(spark, monkeypatch):
    monkeypatch.setattr(registry, "TASK_ROWS", 10)
    assert "ResolvedHint" in registry.at_hand(spark.range(10))._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in registry.at_hand(spark.range(11))._jdf.queryExecution().analyzed().toString()


def test_wide_rows_meet_where_their_sources_lie(spark):
    """Sources are grouped where they meet their orders, and attributes come to them: neither is shuffled again by domain and code. Rows of a domain
    still follow each other."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    had = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        told = wholes.explorer_wide(spark, "/root/testdata/sf0.001")
        physical = told._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\((domain_id|__domain)#\w+, (code|__code)#", physical), physical
        parts = told.select("domain").rdd.mapPartitions(lambda rows: [[r.domain for r in rows]]).collect()
    finally:
        for c, v in had.items():
            spark.conf.set(c, v)
    assert len(parts) > 1
    for domains in parts:
        assert sum(a != b for a, b in zip(domains, domains[1:])) < max(1, len(set(domains)))
