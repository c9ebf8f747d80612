"""Sheets to entities, intake and sinks, on small rows with nulls, blanks and repeats."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entities as E
from tidemark.operators import reconcile as M
from tidemark.operators import repair as P
from tidemark.sources import contracts, sheets
from tidemark.sources.versions import Store
from tidemark.streaming.intake import ROWS, intake


def test_contracts_name_seven_sheets():
    assert len(contracts.ALL) == 7 and len({c.name for c in contracts.ALL}) == 7
    assert all(set(c.required) <= set(c.columns) and set(c.dates) <= set(c.columns) and len(set(c.columns)) == len(c.columns) for c in contracts.ALL)
    assert len(contracts.ATTRIBUTES.columns) == 18


def test_attributes_hide_personal_texts_unless_flagged(spark):
    base = dict.fromkeys(contracts.ATTRIBUTES.columns, "-") | {"codigo_dominio": " ADS ", "codigo_atributo": "4", "categoria_nivel_1": "salud", "fecha_aprobada": "31/1/2026", "reporte": "X"}
    rows = [base | {"es_dato_personal": "Sí"}, base | {"es_dato_personal": "No"}, base | {"es_dato_personal": None, "codigo_atributo": None, "reporte": "x"}]
    got = E.attributes(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in contracts.ATTRIBUTES.columns))).collect()
    assert [(r.codigo_dominio, r.categoria_nivel_1, r.reporte) for r in got[:2]] == [("ADS", "salud", True), ("ADS", None, True)] and got[0].errors == ""
    assert str(got[0].fecha_aprobada) == "2026-01-31" and got[2].categoria_nivel_1 is None and got[2].errors != ""


def test_consumption_repeats_and_conflicts(spark):
    names = contracts.CONSUMPTION.columns
    row = ("ADS-1", "c", "set", "srv", "t", "f", "2026-01-31 00:00:00")
    rows = [row, row, ("ADS-2", *row[1:]), ("ADS-2", *row[1:-1], "1/2/2026"), ("ADS-3", "c", "set", "-", "t", "f", None)]
    got = {r.codigo_dominio_atributo: r for r in E.consumption(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))).collect()}
    assert len(got) == 3 and got["ADS-1"].errors == "" and str(got["ADS-1"].fecha_aprobada) == "2026-01-31"
    assert got["ADS-2"].errors == "several dates" and got["ADS-2"].fecha_aprobada is None and got["ADS-3"].errors == "missing: servidor_foc"


def test_intake_takes_contents_once_and_keeps_equal_rows(spark, tmp_path):
    schema, root = "k long, v string", str(tmp_path)

    def put(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/{name}")

    def taken(checkpoint="checkpoint"):
        intake(spark, f"{root}/in/*", schema, f"{root}/out", f"{root}/{checkpoint}", files_per_batch=1).awaitTermination()
        return sorted(((r.k, r.v) for r in Store(spark, f"{root}/out").read(ROWS).collect()), key=lambda r: (r[0], r[1] or ""))

    put([(1, "a"), (1, "a"), (2, None)], "one")
    put([(1, "a"), (1, "a"), (2, None)], "again")
    put([(1, "a")], "other")
    want = [(1, "a"), (1, "a"), (1, "a"), (2, None)]
    assert taken() == want
    put([(1, "a")], "late copy")
    assert taken() == want
    # the same rows in another order are another content
    put([(1, "a"), (2, None), (1, "a")], "turned")
    want = sorted([*want, (1, "a"), (1, "a"), (2, None)], key=lambda r: (r[0], r[1] or ""))
    assert taken() == want
    # batches that are run again: without their checkpoint, they start from number 0
    assert taken("other checkpoint") == want


def test_sinks(spark, tmp_path):
    drawn, other = spark.createDataFrame([(1, "RESOLVED")], "id long, state string"), spark.createDataFrame([(2, None)], "id long, state string")
    sheets.write_relations(drawn, other, f"{tmp_path}/relations")
    assert sorted(r.id for r in spark.read.options(sep=";", header="true").csv(f"{tmp_path}/relations").collect()) == ["1", "2"]
    sheets.write_events(drawn, f"{tmp_path}/events")
    sheets.write_events(other, f"{tmp_path}/events")
    assert spark.read.text(f"{tmp_path}/events").count() == 2
    model = drawn.withColumn("sources", F.array(F.lit("x")))
    sheets.write_sections(model, {"names": ["id"], "full": ["id", "sources"]}, f"{tmp_path}/model")
    assert sorted(r.section for r in spark.read.json(f"{tmp_path}/model").collect()) == ["full", "names"]
    name = sheets.publish_snapshot(drawn, f"{tmp_path}/snapshots")
    assert name and sheets.current_snapshot(spark, f"{tmp_path}/snapshots").count() == 1
    assert sheets.stamped(drawn, None).columns == ["id", "state"] and sheets.stamped(drawn, 3).first().id_load == 3


def test_dry_run_hands_nothing_on(spark):
    plan, taken = spark.createDataFrame([(1,)], "k long"), []
    assert M.planned(plan, None) is plan and M.planned(plan, taken.append) is plan and taken == [plan]


def test_repairs_fill_and_retire(spark):
    df = spark.createDataFrame([(1, None, True), (2, None, True), (3, "own", True), (4, None, False)], "k long, v string, active boolean")
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (4, "d")], "k long, v string")
    assert {r.k: r.v for r in P.fill_unique(df, source, ["k"], "v").collect()} == {1: "a", 2: None, 3: "own", 4: None}
    rows = spark.createDataFrame([(1, 5, True), (1, 7, True), (2, 1, True)], "k long, n long, active boolean").withColumn("end_date", F.lit(None).cast("date"))
    got = P.retire_duplicates(rows, ["k"], [F.col("n").desc()], F.to_date(F.lit("2026-01-01"))).collect()
    assert {(r.k, r.n): (r.active, r.retired) for r in got} == {(1, 7): (True, False), (1, 5): (False, True), (2, 1): (True, False)}


def test_empty_entities(spark):
    for c in (contracts.RESEARCH, contracts.PLANS):
        assert E.paired(spark.createDataFrame([], ", ".join(f"`{x}` string" for x in c.columns)), c).count() == 0
    with pytest.raises(ValueError, match="missing columns"):
        sheets.scan(spark, "/root/testdata/sf0.001/region.parquet", contracts.RESEARCH, kind="parquet")


def test_plans_have_numbers_and_split_codes(spark):
    base = dict.fromkeys(contracts.PLANS.columns) | {"codigo_dominio_atributo": "AB-C-12 ", "id_problema": "P1"}
    rows = [base | {"avance": v, "id_problema": str(k)} for k, v in enumerate(["7", "7.0", "-", None, "half"])] + [base | {"codigo_dominio_atributo": "nocode", "id_problema": None}]
    got = {r.id_problema: r for r in E.plans(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in contracts.PLANS.columns))).collect()}
    assert [got[str(k)].avance for k in range(5)] == [7, 7, None, None, None] and got["0"].errors == "" and "half" in got["4"].errors
    assert (got["0"].codigo_dominio, got["0"].codigo_atributo) == ("AB-C", 12) and "missing: id_problema" in got[None].errors and "nocode" in got[None].errors


def test_typed_sheets(spark):
    rows = [dict.fromkeys(contracts.ATTRIBUTES.columns, "-") | {"codigo_atributo": a, "fecha_aprobada": d} for a, d in (("4.0", "2026-01-31 00:00:00"), ("x", "soon"))]
    got = E.typed(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in contracts.ATTRIBUTES.columns)), contracts.ATTRIBUTES).collect()
    assert got[0].codigo_atributo == 4 and str(got[0].fecha_aprobada) == "2026-01-31" and got[0].errors == "" and got[1].errors.count(";") == 1
    plain = E.typed(spark.createDataFrame([("a", "-", None, " ")], ", ".join(f"`{c}` string" for c in contracts.RESEARCH.columns)), contracts.RESEARCH).first()
    assert plain.clasificacion == "a" and plain.nombre is None and plain.errors == ""


def test_relations_either_way(spark):
    chosen = spark.createDataFrame([("A", 1, "Código "), ("A", 2, "other")], "domain string, code long, name string")
    links = spark.createDataFrame([("A", 1, "Código", "B", "x", "RESOLVED"), ("B", 9, "y", "A", "CODIGO", "RESOLVED"), ("B", 9, "y", "C", "codigo", "BROKEN"), ("C", 3, "z", None, None, "NO_LINK")], "origin_domain string, origin_code long, origin_name string, target_domain string, target_name string, state string")
    got = sorted(tuple(r) for r in E.relation_details(chosen, links).collect())
    assert got == [("used by", "A", 1, "B", "9 · y", "RESOLVED"), ("uses", "A", 1, "B", "x", "RESOLVED")]


def test_research_is_split_by_class(spark):
    research = spark.createDataFrame([("d", " TÉRMINO"), ("d", "termino"), ("d", "Norma"), ("d", None)], "domain string, classification string")
    told = {k: v.count() for k, v in E.with_terms({}, research).items()}
    assert told == {"research": 2, "terms": 2}


def test_wide_rows_hide_confidential_details(spark):
    from tidemark.operators import kpi as K

    attributes = spark.createDataFrame([(d, c, *[f"{p} {c}" for p in K.PLAIN]) for d, c in ((1, 10), (1, 11), (2, 20), (2, 21), (3, 30))], "domain_id long, code long, " + ", ".join(f"{p} string" for p in K.PLAIN)).withColumns({"criticality": F.lit(" CRÍTICO"), "structure": F.when(F.col("code") == 11, "Sí").otherwise("No")})
    domains = spark.createDataFrame([(1, "A", "a", "Activo"), (2, "B", "b", "Confidencial"), (3, "C", "c", "Inactivo")], "domain_id long, domain string, domain_name string, state_class string")
    path = "domain_id long, code long, server string, database string, table string, field string"
    official = spark.createDataFrame([(1, 10, "s2", "d", None, "f", False), (1, 10, "s9", "d", "t", " ", True), (2, 20, "s", "d", "t", "f", True)], path + ", primary boolean")
    used = spark.createDataFrame([(1, 10, "s", None, "t", "f", "own")], path + ", class string")
    links = spark.createDataFrame([(10, "RESOLVED")], "id long, state string")
    people = spark.createDataFrame([(1, 1, "Ana"), (1, 9, "Ben"), (2, 2, None)], "domain long, role_id int, name string")
    got = {r.code: r for r in K.wide_rows(attributes, domains, official, used, links, people).collect()}
    assert set(got) == {10, 11, 20, 21}
    one = got[10]
    assert (one.full_code, one.official_server, one.official_table, one.official_field, one.official_path) == ("A-10", "s9 | s2", "t | —", "— | f", "s9 / d / t")
    assert (one.has_official, one.n_official, one.consumption_database, one.link_state, one.role_1, one.other_roles, one.points) == ("Sí", 2, "—", "RESOLVED", "Ana", "Ben", 0)
    assert got[11].points == 5 and got[11].official_server == "" and got[11].link_state == "" and "critico" not in got[11].search and "ana" in got[11].search
    assert got[20].official_server == "(confidential)" and got[20].n_official == 1 and got[21].official_server == "" and got[21].points == 3
    assert len([c for c in one.asDict() if not c.startswith(("role_", "other_roles", "search", "points"))]) == 35


def test_codes_of_two_domains_meet_their_own_sources(spark):
    from tidemark.operators import kpi as K

    attributes = spark.createDataFrame([(d, c, *[f"{p} {c}" for p in K.PLAIN]) for d, c in ((1, 10), (2, 10), (2, 20), (None, 30))], "domain_id long, code long, " + ", ".join(f"{p} string" for p in K.PLAIN))
    domains = spark.createDataFrame([(d, f"D{d}", "d", "Activo") for d in (1, 2)], "domain_id long, domain string, domain_name string, state_class string")
    source = "domain_id long, code long, server string, database string, table string, field string, primary boolean, class string"
    official = spark.createDataFrame([(1, 10, "one", "d", "t", "f", True, "c"), (2, 10, "two", "d", "t", "f", True, "c"), (1, 20, "no", "d", "t", "f", True, "c"), (None, 10, "no", "d", "t", "f", True, "c")], source)
    used = spark.createDataFrame([(2, 10, "used", "d", "t", "f", True, "c")], source)
    links = spark.createDataFrame([(10, "RESOLVED")], "id long, state string")
    people = spark.createDataFrame([(1, 1, "Ana")], "domain long, role_id int, name string")
    got = [sorted(map(tuple, K.wide_rows(attributes, domains, official, used, links, people, unique_codes=unique).collect())) for unique in (False, True)]
    told = {(r[0], r[4]): r for r in got[0]}
    assert got[0] == got[1] and len(got[0]) == 3
    assert "one" in told["D1", 10] and "two" in told["D2", 10] and "used" in told["D2", 10] and "no" not in told["D2", 20]
