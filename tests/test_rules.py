"""Fixed cases of the rules, on hand-made rows."""

import datetime as dt
import random
from difflib import get_close_matches

from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.operators import diff, gates, kpi, reconcile, repair, resolve
from tidemark.sources import sheets


def day(text):
    return dt.date.fromisoformat(text)


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_blank_markers(spark):
    assert column(spark, [" a\t", "-", " - ", "", None, "\n"], C.text_or_null) == ["a", None, None, None, None, None]


def test_flags(spark):
    assert column(spark, ["X", "-", "", None, "x"], lambda c: C.x_flag(c)[0]) == [True, False, False, False, None]
    assert column(spark, ["Sí", "SI", "no", "", None], lambda c: C.yes_no(c)[0]) == [True, True, False, None, None]
    assert [e is not None for e in column(spark, ["X", "x"], lambda c: C.x_flag(c)[1])] == [False, True]


def test_tolerant_int(spark):
    assert column(spark, ["70.0", "-", "nan", None, "-3.9", "x"], lambda c: C.tolerant_int(c)[0]) == [70, None, None, None, -3, None]


def test_code_parts(spark):
    assert column(spark, ["ADS-4", "A-B-12", "ADS", None], lambda c: C.code_parts(c)[0]) == ["ADS", "A-B", None, None]
    assert column(spark, ["ADS-4", "A-B-12", "ADS-x"], lambda c: C.code_parts(c)[1]) == [4, 12, None]


def test_dates(spark):
    assert column(spark, ["2025-01-31 00:00:00", "31-01-2025", "1/2/2025", "2025/15/09"], lambda c: C.any_date(c)[0]) == [day("2025-01-31"), day("2025-01-31"), day("2025-02-01"), None]


def test_canonical_text(spark):
    assert column(spark, [1.50, 2.0, None], lambda c: C.canonical(c, "double"), "double") == ["1.5", "2", ""]
    assert column(spark, [True, False, None], lambda c: C.canonical(c, "boolean"), "boolean") == ["Sí", "No", ""]
    assert column(spark, [dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2, 3)], lambda c: C.canonical(c, "timestamp"), "timestamp") == ["2025-01-02", "2025-01-02 03:00:00"]


def test_order_keys(spark):
    df = spark.createDataFrame([("CAC-10",), ("CAC-9",), ("ab",)], "v string")
    assert [r.v for r in df.orderBy(C.chunk_key(F.col("v"))).collect()] == ["ab", "CAC-9", "CAC-10"]
    df = spark.createDataFrame([("10",), ("b",), ("9",), ("A",)], "v string")
    assert [r.v for r in df.orderBy(C.natural_key(F.col("v"))).collect()] == ["9", "10", "A", "b"]
    df = spark.createDataFrame([("2.10.",), ("2.9.",)], "v string")
    assert [r.v for r in df.orderBy(C.dotted_key(F.col("v"))).collect()] == ["2.9.", "2.10."]


def test_header_names(spark):
    assert column(spark, ["  a  b ", "é"], C.header_name) == ["a b", "é"]


def test_version_sequence(spark):
    assert column(spark, [None, "1", "9", "1.0", "abc"], reconcile.next_version) == ["1", "2", "10", "1", "1"]


def test_merge_plan(spark):
    old = spark.createDataFrame([("same", 1, day("2025-01-01")), ("newer", 2, day("2025-01-01")), ("older", 3, day("2025-01-01")), ("gone", 4, day("2025-01-01")), ("undated", 5, None)], "key string, id long, approval_date date")
    new = spark.createDataFrame([("same", day("2025-01-01")), ("newer", day("2025-02-01")), ("older", day("2024-01-01")), ("fresh", day("2025-01-01")), ("undated", day("2025-01-01"))], "key string, approval_date date")
    assert {r.key: r.action for r in reconcile.merge_plan(old, new, ["key"]).collect()} == {"same": "UPDATE", "newer": "REPLACE", "older": "SKIP_DATE_REGRESSED", "gone": "DELETE", "fresh": "INSERT", "undated": "UPDATE"}


def test_second_run_changes_nothing(spark):
    now = spark.createDataFrame([(1, "a", "x", day("2025-01-01"), "1", True, None), (2, "b", "y", day("2025-01-01"), "3", True, None)], "id long, key string, field string, approval_date date, version string, active boolean, end_date date")
    again = reconcile.apply_versions(now, now.select("key", "field", "approval_date"), ["key"], ["field"], F.current_date())
    assert [r.action for r in again.collect()] == ["UNCHANGED", "UNCHANGED"]
    assert reconcile.audit_lines(again, ["key"], F.lit(1)).count() == 0


def test_new_ids_are_gapless(spark):
    df = spark.range(1000).select(F.format_string("%05d", F.col("id")).alias("k")).repartition(7)
    got = reconcile.new_ids(df, ["k"], 10).orderBy("k").collect()
    assert [r.id for r in got] == list(range(11, 1011))


def test_formula_pairs(spark):
    schema = "base string, formula string, approval_date date"
    old = spark.createDataFrame([("f", "old", day("2025-01-01"), 1), ("g", "one", day("2025-01-01"), 2)], schema + ", id long")
    new = spark.createDataFrame([("f", "corrected", day("2025-02-01")), ("g", "one", day("2025-01-01")), ("g", "two", day("2025-01-01"))], schema)
    got = {(r.base, r.formula_key): r.action for r in reconcile.pair_by_formula(old, new, ["base"]).collect()}
    assert got == {("f", ""): "REPLACE", ("g", "one"): "UPDATE", ("g", "two"): "INSERT"}


def scores(spark, rows):
    attributes = spark.createDataFrame(rows, "domain string, critical boolean, structure boolean, has_source boolean")
    return {r.domain: r.score for r in kpi.domain_scores(attributes, spark.createDataFrame([("a",), ("b",), ("c",)], "domain string")).collect()}


def test_domain_scores(spark):
    rows = [("a", True, True, False), ("a", True, False, False), ("a", False, False, False), ("a", False, False, False), ("a", True, True, True)] + [("b", True, True, False)] * 30
    assert scores(spark, rows) == {"a": 90, "b": 0, "c": None}


def test_persons(spark):
    people = spark.createDataFrame([("d1", "Ana López"), ("d2", "ANA LOPEZ"), ("d2", " ana lópez"), ("d1", "Ben"), ("d1", None), ("d1", " ")], "domain string, name string")
    found = kpi.persons(people)
    assert sorted((r.person, r.n_assignments, r.n_domains) for r in found.collect()) == [("ana lopez", 3, 2), ("ben", 1, 1)]
    assert [(r.value, r.n) for r in kpi.gap_histogram(found, "n_domains").orderBy("value").collect()] == [(1, 1), (2, 1)]


def test_changes(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, f string, g string")
    after = spark.createDataFrame([(1, "z", ""), (3, "c", "x")], "k int, f string, g string")
    assert {r.k: (r.change_type, r.n_fields) for r in diff.changes(before, after, ["k"], ["f", "g"]).collect()} == {1: ("MODIFIED", 1), 2: ("REMOVED", 0), 3: ("NEW", 0)}
    assert [tuple(r) for r in diff.field_changes(before, after, ["k"], ["f", "g"]).collect()] == [(1, "f", "a", "z")]


def test_compare_lists(spark):
    template = spark.createDataFrame([("g", "Alta", 1), ("g", "Crítico", 2), ("g", "Mediaa", 3), ("g", "-", 4), ("g", "Nuevo", 5), ("h", "x", 1)], "group string, value string, pos long")
    catalogue = spark.createDataFrame([("g", "Alta"), ("g", "CRITICO"), ("g", "Media"), ("g", "Otro dato")], "group string, value string")
    got = {(r.value, r.status, r.partner) for r in diff.compare_lists(template, catalogue).collect()}
    assert got == {("Crítico", "EQUIVALENT", "CRITICO"), ("Mediaa", "TYPO", "Media"), ("Nuevo", "MISSING", None), ("Otro dato", "EXTRA", None)}


def walked(template, catalogue, ratio=0.75):
    """One group's comparison by walking its lists, on folded values: an equivalent one, else the closest match that is left."""
    known, like = sorted(set(catalogue)), lambda v: " ".join(v.lower().split())
    listed = {}
    for pos, v in template:
        listed[v] = min(pos, listed.get(v, pos))
    rest, out = [v for v in known if v not in listed], set()
    for v in sorted((v for v in listed if v not in known), key=lambda v: (listed[v], v)):
        same = next((r for r in rest if like(r) == like(v)), None)
        named = {like(r): r for r in rest}
        close = [] if same else get_close_matches(like(v), list(named), n=1, cutoff=ratio)
        partner, status = (same, "EQUIVALENT") if same else (named[close[0]], "TYPO") if close else (None, "MISSING")
        if partner:
            rest.remove(partner)
        out.add((v, status, partner))
    return out | {(v, "EXTRA", None) for v in rest}


def test_compare_lists_like_a_walk(spark):
    r = random.Random(11)
    text = lambda: "".join(r.choice("abAB") for _ in range(r.randrange(1, 6))) if r.random() < 0.5 else "".join(r.choice("abcdefgh ") for _ in range(r.randrange(6, 30))).strip() + "x"

    def edited(v):
        at = r.randrange(len(v) + 1)
        return r.choice([v[:at] + v[at + 1 :], v[:at] + "z" + v[at:], v.upper(), v[::-1], v]) or "q"

    template, catalogue = {}, {}
    for g in ("g", "h", "i"):
        catalogue[g] = [text() for _ in range(60)]
        template[g] = [(r.randrange(40), edited(v)) for v in catalogue[g] for _ in range(2)]
    left = spark.createDataFrame([(g, v, p) for g, x in template.items() for p, v in x], "group string, value string, pos long")
    right = spark.createDataFrame([(g, v) for g, x in catalogue.items() for v in x], "group string, value string")
    got = {(x.group, x.value, x.status, x.partner) for x in diff.compare_lists(left, right).collect()}
    assert got == {(g, *x) for g in template for x in walked(template[g], catalogue[g])}
    assert {x[2] for x in got} == {"EQUIVALENT", "TYPO", "MISSING", "EXTRA"}
    nothing = spark.createDataFrame([], left.schema)
    assert diff.compare_lists(nothing, right).count() == right.distinct().count() and diff.compare_lists(left, nothing.drop("pos")).count() == 0


def test_equally_close_values_take_a_fixed_number_of_jobs(spark):
    """A thousand values that are all as close to each other's partners, and a long chain."""

    def jobs(n):
        template = [("g", f"item {k:04d}x", k) for k in range(n)] + [("chain", "ab" * k + "c", k) for k in range(4, 40)]
        catalogue = [("g", f"item {k:04d}y") for k in range(n)] + [("chain", "ab" * k + "d") for k in range(4, 40)]
        left, right = spark.createDataFrame(template, "group string, value string, pos long"), spark.createDataFrame(catalogue, "group string, value string")
        mark = f"lists-{n}"
        spark.sparkContext.setJobGroup(mark, mark)
        got = {(r.group, r.value, r.status, r.partner) for r in diff.compare_lists(left, right).collect()}
        done = len(spark.sparkContext.statusTracker().getJobIdsForGroup(mark))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == {(g, *x) for g in ("g", "chain") for x in walked([(p, v) for h, v, p in template if h == g], [v for h, v in catalogue if h == g])}
        return done

    few, many = jobs(10), jobs(250)
    assert many <= few + 6


def test_controlled_lookup_ignores_case_and_accents(spark):
    df = spark.createDataFrame([(1, "critico"), (2, None), (3, "nada")], "k int, v string")
    catalogue = spark.createDataFrame([("Crítico", 7), ("CRÍTICO", 9)], "text string, id int")
    got = {r.k: (r.id2, r.id2_error is not None) for r in resolve.controlled(df, "v", catalogue, "text", "id", "id2").collect()}
    assert got == {1: (7, False), 2: (None, False), 3: (None, True)}


def test_trimmed_headers(spark):
    h = spark.createDataFrame([("f", "s", 1, "a"), ("f", "s", 2, ""), ("f", "s", 3, "b"), ("f", "s", 4, " ")], "file string, sheet string, pos int, name string")
    assert sorted(r.pos for r in gates.trimmed_headers(h).collect()) == [1, 2, 3]


def test_structure_differences(spark):
    found = spark.createDataFrame([("f", "s", ["b", "a"]), ("g", "s", ["a", "c"])], "file string, sheet string, columns array<string>")
    got = {r.file: (r.missing, r.unexpected, r.reordered) for r in gates.structure_differences(found, spark.createDataFrame([("s", ["a", "b"])], "sheet string, columns array<string>")).collect()}
    assert got == {"f": ([], [], True), "g": (["b"], ["c"], False)}


def test_contract_scan_and_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text(" a ,b,extra\n1, x ,9\n,,\n")
    (tmp_path / "~$one.csv").write_text("lock")
    (tmp_path / "empty.csv").write_text("")
    got = sheets.scan(spark, str(tmp_path / "one.csv"), sheets.Contract("s", ("a", "b"))).collect()
    assert [(r.a, r.b.strip(), r._file) for r in got] == [("1", "x", "one.csv")]
    try:
        sheets.scan(spark, str(tmp_path / "one.csv"), sheets.Contract("s", ("a", "c")))
        raise AssertionError("a missing column must be an error")
    except ValueError as e:
        assert "c" in str(e)
    assert [r.file for r in sheets.settled_files(spark, str(tmp_path), "*.csv").collect()] == ["one.csv"]


def test_snapshots_switch(spark, tmp_path):
    root = str(tmp_path / "t")
    sheets.publish_snapshot(spark.range(3).toDF("k"), root)
    sheets.publish_snapshot(spark.range(5).toDF("k"), root)
    assert sheets.current_snapshot(spark, root).count() == 5
    assert repair.backup_once(spark.range(2), str(tmp_path / "b")) and not repair.backup_once(spark.range(2), str(tmp_path / "b"))


def test_evolve(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    got = repair.evolve(df, {"b": "c"}, {"a": "int"}, {"d": F.lit(True)})
    assert got.columns == ["a", "c", "d"] and got.first().a == 1


def test_aligned(spark):
    df, new, lost = sheets.aligned(spark.createDataFrame([("1", "x")], "a string, b string"), ["b", "z"])
    assert (df.columns, new, lost) == (["b", "z"], ["z"], ["a"])
