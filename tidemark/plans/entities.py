"""Queries of entities. Stand-ins: sheets' texts are made of orders, line items, suppliers and customers; domain = nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import diff as D
from ..operators import entities as E
from ..operators import gates as G
from ..operators import graph as R
from ..operators import kpi as K
from ..operators import reconcile as M
from ..operators import repair as P
from ..operators import resolve as S
from ..sources import contracts, sheets
from . import merging
from .catalogues import loads, LOADS
from .registry import parts, query, table
from .reports import REL, links

# one staged sheet a contract: texts as people type them
ATT_TEXTS = {
    "codigo_dominio": ("concat(' D', o_custkey % 9, ' ')", "' D' || CAST(o_custkey % 9 AS VARCHAR) || ' '"),
    "codigo_atributo": ("case when o_orderkey % 97 = 0 then 'x1' else cast(o_orderkey as string) end", "CASE WHEN o_orderkey % 97 = 0 THEN 'x1' ELSE CAST(o_orderkey AS VARCHAR) END"),
    "atributo": ("concat('name ', o_orderkey)", "'name ' || CAST(o_orderkey AS VARCHAR)"),
    "descripcion_atributo": ("'-'", "'-'"),
    "nivel_criticidad": ("o_orderpriority", "o_orderpriority"),
    "reporte": ("case o_orderkey % 4 when 0 then 'X' when 1 then '-' when 2 then '' else 'y' end", "CASE o_orderkey % 4 WHEN 0 THEN 'X' WHEN 1 THEN '-' WHEN 2 THEN '' ELSE 'y' END"),
    "proyecto": ("'X'", "'X'"),
    "proceso": ("cast(null as string)", "CAST(NULL AS VARCHAR)"),
    "estructura": ("'-'", "'-'"),
    "es_dato_personal": ("case when o_orderkey % 3 = 0 then 'Sí' else 'No' end", "CASE WHEN o_orderkey % 3 = 0 THEN 'Sí' ELSE 'No' END"),
    "categoria_nivel_1": ("'health'", "'health'"),
    "tipo_dato": ("'-'", "'-'"),
    "sensibilidad": ("concat(' ', o_orderstatus)", "' ' || o_orderstatus"),
    "tipo_atributo": ("'base'", "'base'"),
    "compartido_similar": ("''", "''"),
    "atributo_primario": ("'-'", "'-'"),
    "dominio_primario": ("'-'", "'-'"),
    "fecha_aprobada": ("case when o_orderkey % 5 = 0 then date_format(o_orderdate, 'd/M/yyyy') when o_orderkey % 5 = 1 then '' when o_orderkey % 89 = 0 then 'soon' else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end",
                       "CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%-d/%-m/%Y') WHEN o_orderkey % 5 = 1 THEN '' WHEN o_orderkey % 89 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END"),
}


def staged_attributes(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*(f"{x} as {c}" for c, (x, _) in ATT_TEXTS.items()))


DAY = "CAST(CASE WHEN o_orderkey % 5 = 1 OR (o_orderkey % 5 <> 0 AND o_orderkey % 89 = 0) THEN NULL ELSE o_orderdate END AS DATE)"


@query(f"""SELECT 'D' || CAST(o_custkey % 9 AS VARCHAR) AS codigo_dominio, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS codigo_atributo, o_orderkey % 4 = 0 AS reporte, o_orderkey % 3 = 0 AS es_dato_personal,
CASE WHEN o_orderkey % 3 = 0 THEN 'health' END AS categoria_nivel_1, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS sensibilidad, CAST(NULL AS VARCHAR) AS descripcion_atributo, {DAY} AS fecha_aprobada,
CAST(o_orderkey % 97 = 0 AS INT) + CAST(o_orderkey % 4 = 3 AS INT) + CAST(o_orderkey % 5 > 1 AND o_orderkey % 89 = 0 AS INT) AS n_errors FROM orders""")
def attribute_rows(spark, sf):
    told = E.attributes(staged_attributes(spark, sf))
    n = F.when(F.col("errors") == "", 0).otherwise(F.size(F.split("errors", "; ")))
    flag = F.coalesce(F.col("reporte"), F.lit(False))
    return told.select("codigo_dominio", F.col("codigo_atributo").cast("bigint").alias("codigo_atributo"), flag.alias("reporte"), "es_dato_personal", "categoria_nivel_1", "sensibilidad", "descripcion_atributo", "fecha_aprobada", n.alias("n_errors"))


@query("""SELECT 'D-' || CAST(l_orderkey AS VARCHAR) AS codigo_dominio_atributo, CASE WHEN l_linenumber % 3 <> 0 THEN l_linestatus END AS base_datos_fuente_oficial, '-' AS nombre_campo_fuente_oficial, l_returnflag AS longitud_campo_fuente_oficial,
l_linenumber % 2 = 0 AS acepta_valores_nulos, CAST(l_shipdate AS DATE) AS fecha_aprobada, true AS primaria FROM lineitem""")
def official_source_rows(spark, sf):
    texts = {"codigo_dominio_atributo": "concat('D-', l_orderkey, ' ')", "base_datos_fuente_oficial": "if(l_linenumber % 3 = 0, '-', l_linestatus)", "nombre_campo_fuente_oficial": "' - '", "longitud_campo_fuente_oficial": "concat(' ', l_returnflag)", "acepta_valores_nulos": "if(l_linenumber % 2 = 0, 'Sí', 'No')", "fecha_aprobada": "date_format(l_shipdate, 'd/M/yyyy')"}
    staged = table(spark, sf, "lineitem").selectExpr(*(f"{texts.get(c, 'cast(null as string)')} as {c}" for c in contracts.OFFICIAL_SOURCES.columns))
    return E.official_sources(staged).filter("errors = ''").select(*texts, "primaria")


@query("""WITH s AS (SELECT 'D-' || CAST(l_partkey AS VARCHAR) AS code, CASE WHEN l_linenumber % 7 <> 0 THEN l_linestatus END AS server, l_returnflag AS cls, CASE WHEN l_linenumber % 2 = 0 THEN DATE '1998-01-01' ELSE CAST(l_shipdate AS DATE) END AS d FROM lineitem)
SELECT code AS codigo_dominio_atributo, cls AS clase, server AS servidor_foc, CASE WHEN count(DISTINCT d) = 1 THEN max(d) END AS fecha_aprobada, concat_ws('; ', CASE WHEN server IS NULL THEN 'missing: servidor_foc' END, CASE WHEN count(DISTINCT d) > 1 THEN 'several dates' END) AS errors FROM s GROUP BY code, cls, server""")
def consumption_rows(spark, sf):
    staged = table(spark, sf, "lineitem").selectExpr("concat('D-', l_partkey) as codigo_dominio_atributo", "l_returnflag as clase", "'set' as coleccion_foc", "if(l_linenumber % 7 = 0, '-', l_linestatus) as servidor_foc", "'t' as tabla_bv_foc", "'f' as nombre_campo_foc", "if(l_linenumber % 2 = 0, '1998-01-01 00:00:00', date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')) as fecha_aprobada")
    return E.consumption(staged).select("codigo_dominio_atributo", "clase", "servidor_foc", "fecha_aprobada", "errors")


PAIRED = {"research": contracts.RESEARCH, "responsibles": contracts.RESPONSIBLES, "evidence": contracts.EVIDENCE, "plans": contracts.PLANS}


@query(" UNION ALL ".join(f"""SELECT '{name}' AS sheet, c_custkey AS k, CASE WHEN c_custkey % 4 <> 1 THEN 'a' || CAST(c_custkey AS VARCHAR) END AS first, CASE WHEN c_custkey % 6 <> 2 THEN c_mktsegment END AS second,
concat_ws('; ', CASE WHEN c_custkey % 4 = 1 THEN 'missing: {contracts.PAIRS[c.name][0]}' END, CASE WHEN c_custkey % 6 = 2 THEN 'missing: {contracts.PAIRS[c.name][1]}' END) AS errors FROM customer""" for name, c in PAIRED.items()))
def paired_rows(spark, sf):
    customers, out = table(spark, sf, "customer"), None
    for name, c in PAIRED.items():
        a, b = contracts.PAIRS[c.name]
        texts = {a: "case c_custkey % 8 when 1 then ' ' when 5 then '-' else concat(' a', c_custkey) end", b: "if(c_custkey % 6 = 2, null, c_mktsegment)"}
        rest = [x for x in c.columns if x not in texts and x not in c.dates]
        staged = customers.selectExpr(*(f"{x} as `{k}`" for k, x in texts.items()), *(f"cast(c_custkey as string) as `{x}`" for x in rest), *(f"date_format(date'2020-01-31', 'd/M/yyyy') as `{x}`" for x in c.dates))
        told = E.paired(staged, c).select(F.lit(name).alias("sheet"), F.col(rest[0]).cast("bigint").alias("k"), F.col(a).alias("first"), F.col(b).alias("second"), "errors")
        out = told if out is None else out.unionByName(told)
    return out


@query("SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey % 10 <> 0")
def contract_scan(spark, sf):
    """Customers as sheets of text with blank rows, padded header names and a column too many, read back under a contract."""
    path = f"{sheets.shared_folder(spark)}/sheets"
    rows = table(spark, sf, "customer").selectExpr("if(c_custkey % 10 = 0, null, cast(c_custkey as string)) as ` k`", "if(c_custkey % 10 = 0, null, c_name) as `name `", "if(c_custkey % 10 = 0, null, c_mktsegment) as segment", "'extra' as note")
    rows.write.option("header", "true").csv(path)
    told = sheets.scan(spark, path, sheets.Contract("customers", ("k", "name", "segment")), ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    return sheets.stamped(told, None).select(F.col("k").cast("bigint").alias("k"), "name", "segment")


@query("SELECT c_custkey AS k, CAST(41 AS BIGINT) AS id_load FROM customer WHERE c_nationkey = 7")
def stamped_slice(spark, sf):
    rows = table(spark, sf, "customer").filter(sheets.in_slice("c_nationkey", F.lit(7)))
    return sheets.stamped(rows.selectExpr("c_custkey as k"), 41)


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_orderdate AS DATE) END AS d, CASE WHEN o_orderkey % 89 = 0 THEN 'no date: soon' END AS error FROM orders")
def declared_dates(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "case when o_orderkey % 89 = 0 then 'soon' when o_orderkey % 2 = 0 then date_format(o_orderdate, 'd/M/yyyy') else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as text")
    value, error = C.declared_date(F.col("text"), contracts.STORED)
    return o.select("k", value.alias("d"), error.alias("error"))


@query("SELECT l_orderkey AS k, l_linenumber AS line, concat_ws(' / ', l_linestatus, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END, CASE WHEN l_linenumber % 3 = 0 THEN l_linestatus END) AS path FROM lineitem")
def path_texts(spark, sf):
    part = lambda n, c: F.when(F.col("l_linenumber") % n == 0, F.col(c)).otherwise(F.when(F.col("l_orderkey") % 2 == 0, F.lit("  ")))
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), C.join_present(" / ", F.col("l_linestatus"), part(2, "l_returnflag"), part(3, "l_linestatus")).alias("path"))


@query("SELECT l_orderkey AS k, l_linenumber AS line, concat_ws(',', CASE WHEN l_linenumber = 1 THEN 'server' END, CASE WHEN l_linenumber % 4 = 0 THEN 'field' END) AS missing FROM lineitem")
def required_links(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_linenumber as line", "if(l_linenumber = 1, null, l_suppkey) as server", "l_partkey as database", "if(l_linenumber % 4 = 0, ' ', l_linestatus) as field")
    return S.required(li, "server", "database", "field").select("k", "line", "missing")


@query("SELECT o_orderkey AS k, CASE WHEN c_acctbal > 0 THEN o_custkey END AS attribute_id, CASE WHEN c_acctbal > 0 THEN NULL ELSE 'unknown value: ' || CAST(o_custkey AS VARCHAR) END AS error FROM orders JOIN customer ON o_custkey = c_custkey")
def active_attribute(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "cast(o_custkey as string) as code")
    live = table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr("cast(c_custkey as string) as code", "c_custkey as id")
    told = S.controlled(o, "code", live, "code", "id", "attribute_id", collated=False)
    return told.select("k", "attribute_id", F.col("attribute_id_error").alias("error"))


@query(f"WITH {LOADS} SELECT id_load, state AS stage, CAST(domain % 3 AS BIGINT) AS object, count(*) AS n FROM loads GROUP BY ALL")
def load_detail_rows(spark, sf):
    return G.load_details(loads(spark, sf).select("id_load", F.col("state").alias("stage"), (F.col("domain") % 3).cast("bigint").alias("object")))


@query(f"WITH {REL} SELECT id, state, state IN ('RESOLVED', 'TARGET_INACTIVE', 'NO_TYPE', 'SAME_DOMAIN') AS drawn FROM lk ".replace("state IN ('RESOLVED', 'TARGET_INACTIVE', 'NO_TYPE', 'SAME_DOMAIN')", "state IN ({})".format(", ".join(f"'{s}'" for s in R.DRAWN))))
def all_relations(spark, sf):
    told = links(spark, sf)
    drawn = told.filter(F.col("state").isin(*R.DRAWN)).select("id", "state", F.lit(True).alias("drawn"))
    return drawn.unionByName(R.problems(told).select("id", "state", F.lit(False).alias("drawn")))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey * 10 AS id, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price FROM orders WHERE o_orderkey % 5 <> 0), n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'b' ELSE 'a' END AS formula, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - 1 AS INTEGER) AS d, o_totalprice + o_orderkey % 2 AS price FROM orders WHERE o_orderkey % 7 <> 0),
p AS (SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NOT NULL AND n.k IS NOT NULL THEN '' WHEN o.k IS NULL THEN formula ELSE 'a' END AS formula_key, o.id, CASE WHEN o.k IS NULL THEN 'INSERT' WHEN n.k IS NULL THEN 'DELETE' WHEN n.d = o.d THEN 'UPDATE' WHEN n.d > o.d THEN 'REPLACE' ELSE 'SKIP_DATE_REGRESSED' END AS a, o.price AS op, n.price AS np, o.d AS od, n.d AS nd FROM o FULL JOIN n USING (k))
SELECT id, k, formula_key, CASE WHEN a = 'UPDATE' THEN np ELSE op END AS price, a NOT IN ('REPLACE', 'DELETE') AS active, CASE WHEN a = 'UPDATE' AND op = np THEN 'UNCHANGED' ELSE a END AS action FROM p WHERE a <> 'INSERT' UNION ALL SELECT NULL, k, formula_key, np, true, a || '_NEW' FROM p WHERE a IN ('INSERT', 'REPLACE')""")
def source_apply(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter("o_orderkey % 5 <> 0").selectExpr("o_orderkey * 10 as id", "o_orderkey as k", "'a' as formula", "to_date(o_orderdate) as approval_date", "o_totalprice as price", "'1' as version", "true as active", "cast(null as date) as end_date")
    new = o.filter("o_orderkey % 7 <> 0").selectExpr("o_orderkey as k", "if(o_orderkey % 2 = 0, 'b', 'a') as formula", "date_add(to_date(o_orderdate), cast(o_orderkey % 3 - 1 as int)) as approval_date", "o_totalprice + o_orderkey % 2 as price")
    n = parts(o)
    old, new = M.with_formula_key(old.repartition(n, "k"), new.repartition(n, "k"), ["k"])
    old, new = (df.repartition(n, "k", "formula_key") for df in (old, new))
    return M.apply_versions(old, new, ["k", "formula_key"], ["price"], merging.end()).select("id", "k", "formula_key", "price", "active", "action")


@query("""WITH t AS (SELECT p_partkey AS table_id, p_name AS name FROM part), o AS (SELECT l_orderkey AS k, l_partkey AS table_id, min(l_linenumber) AS line FROM lineitem WHERE l_linenumber < 4 GROUP BY 1, 2), n AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS table_id FROM lineitem WHERE l_linenumber > 2)
SELECT coalesce(o.k, n.k) AS k, coalesce(o.table_id, n.table_id) AS table_id, CASE WHEN o.k IS NULL THEN 'INSERT' WHEN n.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action FROM o FULL JOIN n ON o.k = n.k AND o.table_id = n.table_id""")
def resolved_keys(spark, sf):
    """Names become ids before the plan, so spellings of a catalogue don't part keys."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    old = li.filter("l_linenumber < 4").groupBy(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("table_id")).agg(F.min("l_linenumber").alias("id"))
    named = li.filter("l_linenumber > 2").selectExpr("l_orderkey as k", "concat('Table ', l_partkey) as name")
    catalogue = p.selectExpr("p_partkey as id", "concat('TABLE ', p_partkey) as name")
    new = S.controlled(named, "name", catalogue, "name", "id", "table_id").select("k", "table_id").distinct()
    return M.undated_plan(old, new, ["k", "table_id"]).select("k", "table_id", "action")


@query(f"""WITH {merging.APPLIED}, c AS (SELECT domain, replace(action, '_NEW', '') AS action FROM applied WHERE action <> 'REPLACE') SELECT domain, {', '.join(f"CAST(count(*) FILTER (action = '{a}') AS BIGINT) AS {a.lower()}" for a in ('INSERT', 'UPDATE', 'REPLACE', 'DELETE', 'SKIP_DATE_REGRESSED', 'UNCHANGED'))} FROM c GROUP BY domain""")
def applied_counts(spark, sf):
    applied = merging.scd_apply(spark, sf).filter("action <> 'REPLACE'").withColumn("action", F.regexp_replace("action", "_NEW$", ""))
    return M.action_counts(applied, ["domain"], (M.INSERT, M.UPDATE, M.REPLACE, M.DELETE, M.SKIP, "UNCHANGED"))


@query(f"WITH {merging.BASE} SELECT domain, k, action, existing_id, old_date, new_date FROM plan")
def dry_run(spark, sf):
    """The plan alone: nothing is written without a sink."""
    plan = M.merge_plan(merging.existing(spark, sf), merging.incoming(spark, sf), ["domain", "k"])
    return M.planned(plan, None)


@query("SELECT CASE WHEN c_custkey % 9 > 1 THEN c_mktsegment END AS value, count(*) AS n FROM customer GROUP BY 1")
def distinct_keys(spark, sf):
    return E.distinct_keys(table(spark, sf, "customer").selectExpr("case c_custkey % 9 when 0 then null when 1 then ' - ' else concat(c_mktsegment, ' ') end as key"), "key")


STAR = "SELECT o_orderkey AS k, c_name AS customer, n_name AS nation, r_name AS region FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"


@query(STAR)
def star_rows(spark, sf):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    facts = E.star(o.selectExpr("o_orderkey as k", "o_custkey"), [("o_custkey", c, "c_custkey", "c_name", "customer"), ("o_custkey", c, "c_custkey", "c_nationkey", "nation_id"), ("nation_id", n, "n_nationkey", "n_name", "nation"), ("nation_id", n, "n_nationkey", "n_regionkey", "region_id"), ("region_id", r, "r_regionkey", "r_name", "region")])
    return facts.select("k", "customer", "nation", "region")


@query("""WITH li AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS shared FROM lineitem)
SELECT 'region' AS entity, CAST(r_regionkey AS VARCHAR) AS key, r_name AS label, r_name AS fields FROM region UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name, n_name FROM nation UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name, s_name FROM supplier UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name, p_brand FROM part UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), o_orderpriority, o_orderstatus FROM orders
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) || CASE WHEN shared THEN '|' || CAST(l_linenumber AS VARCHAR) ELSE '' END, l_linestatus, l_returnflag FROM li""")
def entity_snapshot(spark, sf):
    told = {"region": (["r_regionkey"], "r_name", "r_name"), "nation": (["n_nationkey"], "n_name", "n_name"), "customer": (["c_custkey"], "c_name", "c_mktsegment"), "supplier": (["s_suppkey"], "s_name", "s_name"), "part": (["p_partkey"], "p_name", "p_brand"), "orders": (["o_orderkey"], "o_orderpriority", "o_orderstatus"), "lineitem": (["l_orderkey", "l_suppkey"], "l_linestatus", "l_returnflag")}
    out = None
    for name, (keys, label, field) in told.items():
        one = D.snapshot(table(spark, sf, name), name, keys, F.col(label), [field], "l_linenumber" if name == "lineitem" else None)
        one = one.select("entity", F.array_join("key", "|").alias("key"), "label", F.array_join(F.map_values("fields"), "|").alias("fields"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH {REL}, l AS (SELECT domain_id AS d, count(*) FILTER (state = 'RESOLVED') AS n_resolved, count(*) FILTER (state <> 'RESOLVED') AS n_pending FROM lk WHERE state <> 'NO_LINK' GROUP BY 1),
x AS (SELECT n_nationkey AS domain, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9950) AS n_consumption, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000) AS n_evidence, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9900) AS n_terms FROM nation)
SELECT x.*, n_resolved, n_pending, n_consumption > 0 AS has_consumption, n_evidence > 0 AS has_evidence, n_terms > 0 AS has_terms, n_pending = 0 AS links_complete FROM x LEFT JOIN l ON d = domain""")
def compliance_flags(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    told = links(spark, sf).filter("state <> 'NO_LINK'").select(F.col("domain_id").alias("domain"), (F.col("state") == "RESOLVED").alias("resolved"))
    return E.compliance(table(spark, sf, "nation").selectExpr("n_nationkey as domain"), c.filter("c_acctbal > 9950").selectExpr("c_nationkey as domain"), s.filter("s_acctbal > 9000").selectExpr("s_nationkey as domain"), c.filter("c_acctbal > 9900").selectExpr("c_nationkey as domain"), told)


@query("""WITH a AS (SELECT o_orderkey AS k FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) SELECT 'official' AS section, l_orderkey AS k, l_linestatus AS detail FROM lineitem WHERE l_linenumber = 1 AND l_orderkey IN (FROM a) UNION ALL SELECT 'consumption', l_orderkey, l_returnflag FROM lineitem WHERE l_linenumber > 1 AND l_orderkey IN (FROM a)""")
def detail_extracts(spark, sf):
    chosen = K.faceted(table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderpriority as priority"), {"priority": ["1-URGENT", "2-HIGH"]})
    li = table(spark, sf, "lineitem")
    return E.details(chosen, ["k"], {"official": li.filter("l_linenumber = 1").selectExpr("l_orderkey as k", "l_linestatus as detail"), "consumption": li.filter("l_linenumber > 1").selectExpr("l_orderkey as k", "l_returnflag as detail")})


def places(df: DataFrame, group: list[str], order: list) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


@query("""SELECT o_custkey AS owner, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, CASE WHEN o_orderkey % 7 = 0 THEN '9999' ELSE strftime(o_orderdate, '%Y-%m-%d') END, o_orderkey) AS place FROM orders""")
def plan_order(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_custkey as owner", "o_orderkey as k", "case o_orderstatus when 'O' then 'Alertado' when 'P' then 'En  proceso' else 'FINALIZADO' end as state", "if(o_orderkey % 7 = 0, null, o_orderdate) as due", "cast(o_orderkey as string) as code")
    return places(o, ["owner"], E.plan_order(F.col("state"), F.col("due"), F.col("code"))).select("owner", "k", "place")


@query("SELECT l_orderkey AS k, l_linenumber AS line, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber % 2, l_linestatus, l_linenumber) AS place FROM lineitem")
def source_order(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_linenumber as line", "l_linenumber % 2 = 0 as primary", "l_linestatus as server", "lpad(l_linenumber, 3, '0') as field")
    return places(li, ["k"], E.source_order(F.col("primary"), F.col("server"), F.col("field"))).select("k", "line", "place")


@query("""WITH c AS (SELECT c_nationkey AS g, c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN CAST(c_custkey % 200 AS VARCHAR) ELSE c_name END AS code, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS amount FROM customer)
SELECT g AS "group", k, row_number() OVER (PARTITION BY g ORDER BY code IS NULL, CASE WHEN k % 3 = 1 THEN 0 ELSE 1 END, CASE WHEN k % 3 = 1 THEN k % 200 END, lower(code), k) AS by_code, row_number() OVER (PARTITION BY g ORDER BY amount IS NULL, amount DESC, k) AS by_amount FROM c""")
def any_column_order(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_nationkey as group", "c_custkey as k", "case c_custkey % 3 when 0 then null when 1 then cast(c_custkey % 200 as string) else c_name end as code", "if(c_custkey % 5 = 0, null, c_acctbal) as amount")
    over = lambda *order: F.row_number().over(Window.partitionBy("group").orderBy(*order, "k"))
    return c.select("group", "k", over(*E.any_order(F.col("code"), False)).alias("by_code"), over(*E.any_order(F.col("amount"), True, True)).alias("by_amount"))


@query("SELECT o_custkey AS owner, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3, o_orderkey % 12, o_orderkey) AS place FROM orders")
def dotted_order(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_custkey as owner", "o_orderkey as k", "concat(o_orderkey % 3, '.', o_orderkey % 12, '.') as code")
    return places(o, ["owner"], [C.dotted_key(F.col("code")), "k"]).select("owner", "k", "place")


@query("""WITH s AS (SELECT c_nationkey AS domain, CASE WHEN count(*) FILTER (c_acctbal > 9000) > 0 THEN count(*) FILTER (c_acctbal > 9000) END AS score FROM customer GROUP BY 1) SELECT domain, score, row_number() OVER (ORDER BY score IS NULL, score, domain) AS place FROM s""")
def score_ranking(spark, sf):
    n = F.count_if(F.col("c_acctbal") > 9000)
    scores = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("domain")).agg(F.when(n > 0, n).alias("score"))
    return M.new_ids(scores.withColumn("no_score", F.col("score").isNull()), ["no_score", "score", "domain"], name="place").drop("no_score")


@query("""WITH c AS (SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1) SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS by_count, row_number() OVER (ORDER BY coalesce(list_position(['MACHINERY', 'BUILDING'], value), 3), value) AS by_list FROM c""")
def category_order(spark, sf):
    counts = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n"))
    rank = F.array_position(F.array(F.lit("MACHINERY"), F.lit("BUILDING")), F.col("value"))
    ranked = M.new_ids(counts.withColumns({"less": -F.col("n"), "rank": F.when(rank > 0, rank).otherwise(3)}), ["less", "value"], name="by_count")
    return M.new_ids(ranked, ["rank", "value"], name="by_list").drop("less", "rank")


@query("""WITH p AS (SELECT lower(s_name) AS person, count(*) AS n, count(DISTINCT s_nationkey) AS d FROM (SELECT 'P' || CAST(s_suppkey % 13 AS VARCHAR) AS s_name, s_nationkey FROM supplier) GROUP BY 1) SELECT person, n AS n_assignments, d AS n_domains, row_number() OVER (ORDER BY n DESC, d DESC, person) AS place FROM p""")
def person_order(spark, sf):
    who = table(spark, sf, "supplier").select(C.fold(F.expr("concat('P', s_suppkey % 13)")).alias("person"), "s_nationkey")
    told = who.groupBy("person").agg(F.count("*").alias("n_assignments"), F.count_distinct("s_nationkey").alias("n_domains"))
    return M.new_ids(told.withColumns({"a": -F.col("n_assignments"), "b": -F.col("n_domains")}), ["a", "b", "person"], name="place").drop("a", "b")


@query("""WITH u AS (SELECT l_orderkey AS k, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS mode FROM lineitem GROUP BY 1) SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN mode ELSE o_orderstatus END AS value FROM orders LEFT JOIN u ON k = o_orderkey""")
def unique_fill(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "if(o_orderkey % 3 = 0, null, o_orderstatus) as value", "true as active")
    return P.fill_unique(o, table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_linestatus as value"), ["k"], "value").select("k", "value")


@query("""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS line, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3 ORDER BY l_shipdate DESC, l_linenumber DESC) AS n FROM lineitem) SELECT k, line, n = 1 AS active, CASE WHEN n > 1 THEN DATE '1999-01-01' END AS end_date, CASE WHEN n > 1 THEN 'DELETE' END AS audit FROM r""")
def duplicate_retirement(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_linenumber as line", "l_suppkey % 3 as s", "l_shipdate as d", "true as active", "cast(null as date) as end_date")
    told = P.retire_duplicates(li, ["k", "s"], [F.col("d").desc(), F.col("line").desc()], merging.end())
    return told.select("k", "line", "active", "end_date", F.when(F.col("retired"), F.lit(M.DELETE)).alias("audit"))
