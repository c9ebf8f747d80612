"""Queries of publication, files and versions: nested models, events, aligned projections, identification, overviews, ordered ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import diff as D
from ..operators import gates as G
from ..operators import graph as R
from ..operators import kpi as K
from ..operators import reconcile as M
from ..operators import repair as P
from ..operators import validate as V
from ..sources import sheets
from .catalogues import ASKED, LOADS, REGISTRY, loads
from .registry import query, table
from .reports import REL, links


@query("SELECT o_orderkey AS k, coalesce((SELECT string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey), '') AS sources FROM orders")
def nested_model(spark, sf):
    o, li = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k")), table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_linenumber as line", "l_suppkey as supp")
    packed = K.nested_model(o, li, ["k"], ["line", "supp"], "sources")
    return packed.select("k", F.coalesce(F.array_join(F.transform("sources", lambda x: F.concat_ws(":", x["line"].cast("string"), x["supp"].cast("string"))), ","), F.lit("")).alias("sources"))


@query("""SELECT '{"file":' || CAST(o_orderkey AS VARCHAR) || ',"state":"' || o_orderstatus || '","n":' || CAST(o_custkey AS VARCHAR) || '}' AS value FROM orders""")
def event_records(spark, sf):
    return sheets.events(table(spark, sf, "orders").selectExpr("o_orderkey as file", "o_orderstatus as state", "o_custkey as n"))


@query("SELECT c_custkey AS k, c_name AS name, CAST(NULL AS VARCHAR) AS added FROM customer")
def aligned_projection(spark, sf):
    return sheets.aligned(table(spark, sf, "customer").selectExpr("c_custkey as k", "c_name as name", "c_acctbal as lost"), ["k", "name", "added"])[0]


@query(f"WITH r AS (SELECT * FROM {REGISTRY}), k AS (SELECT fingerprint, arg_max(version, CASE WHEN state = 'LIVE' THEN 1 ELSE 0 END * 1000 + CAST(replace(version, '.', '') AS INTEGER)) AS version FROM r WHERE state <> 'DRAFT' GROUP BY 1) SELECT file, f.fingerprint, version FROM (SELECT o_orderkey AS file, 'f' || CAST(o_orderkey % 9 AS VARCHAR) AS fingerprint FROM orders) f LEFT JOIN k ON k.fingerprint = f.fingerprint")
def identify_by_fingerprint(spark, sf):
    files = table(spark, sf, "orders").selectExpr("o_orderkey as file", "concat('f', o_orderkey % 9) as fingerprint")
    return G.identify(files, spark.sql(f"SELECT * FROM {REGISTRY}"))


@query("SELECT o_orderkey AS file, CASE WHEN o_orderkey % 5 = 0 THEN 'REJECTED_CONTROL' WHEN o_orderkey % 7 = 0 THEN 'REJECTED_VERSION' WHEN o_orderkey % 3 = 0 OR o_orderkey % 11 = 0 THEN 'REJECTED_DOMAIN' ELSE 'ACCEPTED' END AS gate FROM orders")
def identity_gate(spark, sf):
    files = table(spark, sf, "orders").selectExpr("o_orderkey as file", "if(o_orderkey % 7 = 0, 'other', 'catalogue') as template", "'A' as declared_domain", "case when o_orderkey % 3 = 0 then null when o_orderkey % 11 = 0 then 'B' else 'A' end as anchor_domain", "o_orderkey % 5 <> 0 as has_control")
    return G.identity_gate(files, "catalogue")


@query(f"""SELECT o_orderkey AS k, list_extract({ASKED}, CAST(o_orderkey % 8 AS INTEGER) + 1) AS version, CAST(o_orderkey % 8 IN (0, 4, 5, 6, 7) AS BOOLEAN) AS new_enough FROM orders""")
def version_order(spark, sf):
    v = F.element_at(F.array(*map(F.lit, ASKED)), (F.col("o_orderkey") % 8).cast("int") + 1)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), v.alias("version"), (C.semver(v)[0] >= C.semver(F.lit("1.10.0"))[0]).alias("new_enough"))


@query(f"""WITH {LOADS}, good AS (SELECT domain, max(id_load) AS last_id, arg_max(hash, id_load) AS version FROM loads WHERE state IN ('MERGE_OK', 'SKIPPED_UNCHANGED') GROUP BY 1),
st AS (SELECT c_custkey % 150 AS domain, CASE WHEN c_custkey % 4 = 0 THEN c_custkey ELSE last_id END AS id_load FROM customer LEFT JOIN good ON good.domain = c_custkey % 150), co AS (SELECT s_suppkey % 60 AS domain, count(*) AS n FROM supplier GROUP BY 1),
s AS (SELECT st.domain, sum(CASE WHEN id_load = last_id THEN 1 ELSE 0 END) AS n_own, sum(CASE WHEN id_load IS NOT DISTINCT FROM last_id THEN 0 ELSE 1 END) AS n_other FROM st LEFT JOIN good ON good.domain = st.domain GROUP BY 1),
x AS (SELECT d.domain, last_id, version, CAST(coalesce(n_own, 0) AS BIGINT) AS n_own, CAST(coalesce(n_other, 0) AS BIGINT) AS n_other, coalesce(co.n, 0) AS n_consumption FROM (SELECT DISTINCT c_custkey % 200 AS domain FROM customer) d LEFT JOIN good ON good.domain = d.domain LEFT JOIN s ON s.domain = d.domain LEFT JOIN co ON co.domain = d.domain)
SELECT *, CASE WHEN last_id IS NULL THEN 'NO_GOOD_LOAD' WHEN n_own > 0 AND n_other = 0 THEN 'FROM_STAGING' WHEN version = md5('7') THEN 'NEEDS_ARCHIVE' ELSE 'OLD_VERSION' END AS verdict FROM x""")
def generation_diagnosis(spark, sf):
    history, c, s = loads(spark, sf).withColumn("version", F.col("hash")), table(spark, sf, "customer"), table(spark, sf, "supplier")
    last = G.last_good(history).select(F.col("domain"), "last_id")
    staged = c.selectExpr("c_custkey as k", "c_custkey % 150 as domain").join(last, "domain", "left").selectExpr("domain", "if(k % 4 = 0, k, last_id) as id_load")
    return G.generation_diagnosis(c.selectExpr("c_custkey % 200 as domain").distinct(), history, staged, s.selectExpr("s_suppkey % 60 as domain"), "8f14e45fceea167a5a36dedd4bea2543")


@query("""WITH a AS (SELECT l_orderkey AS k, list(l_returnflag || CAST(l_linenumber AS VARCHAR) ORDER BY l_linenumber) AS have FROM lineitem GROUP BY 1), b AS (SELECT ['A1', 'N2', 'R3'] AS want)
SELECT k AS file, array_to_string(list_filter(want, lambda x: NOT list_contains(have, x)), ',') AS missing, array_to_string(list_sort(list_distinct(list_filter(have, lambda x: NOT list_contains(want, x)))), ',') AS unexpected FROM a, b""")
def structure_differences(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("file")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))), lambda x: F.concat(x["l_returnflag"], x["l_linenumber"].cast("string"))).alias("columns"))
    declared = spark.range(1).select(F.lit("s").alias("sheet"), F.array(F.lit("A1"), F.lit("N2"), F.lit("R3")).alias("columns"))
    told = G.structure_differences(li.withColumn("sheet", F.lit("s")), declared)
    return told.select("file", F.array_join("missing", ",").alias("missing"), F.array_join(F.array_sort("unexpected"), ",").alias("unexpected"))


@query(f"WITH {REL} SELECT origin, target, type, n, n_inactive, row_number() OVER (ORDER BY n DESC, origin, target, type) AS id FROM ed")
def edge_ids(spark, sf):
    ordered = R.edges(links(spark, sf)).withColumn("less", -F.col("n"))
    return M.new_ids(ordered, ["less", "origin", "target", "type"]).drop("less")


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'Sí' ELSE 'No' END AS flag, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_orderkey % 4 AS VARCHAR) || CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '.5' WHEN 2 THEN '.25' ELSE '.75' END AS number, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS text FROM orders""")
def canonical_texts(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderkey % 2 = 0 as flag", "o_orderdate as day", "cast(o_orderkey % 4 + case o_orderkey % 4 when 0 then 0 when 1 then 0.5 when 2 then 0.25 else 0.75 end as double) as number", "if(o_orderkey % 3 = 0, null, concat(' ', o_orderpriority)) as text")
    return o.select("k", *(C.canonical(F.col(c), k).alias(c) for c, k in (("flag", "boolean"), ("day", "timestamp"), ("number", "double"), ("text", "string"))))


@query("SELECT DISTINCT s_name AS name FROM supplier WHERE s_suppkey % 6 <> 5 AND s_acctbal > 0")
def recipients(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("if(s_suppkey % 6 = 5, null, s_suppkey % 6) as role_id", "s_name as name", "s_acctbal > 0 as active")
    return s.filter("active and role_id is not null").select(C.text_or_null(F.col("name")).alias("name")).filter("name is not null").distinct()


@query("SELECT v.section, count(source) AS n FROM (VALUES ('src0'), ('src1'), ('none')) v(section) LEFT JOIN documents ON source = v.section GROUP BY 1 UNION ALL SELECT source, count(*) FROM documents WHERE source NOT IN ('src0', 'src1', 'none') GROUP BY 1")
def research_sections(spark, sf):
    d = table(spark, sf, "documents")
    counts = d.groupBy(F.col("source").alias("section")).agg(F.count("*").alias("n"))
    fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, ("src0", "src1", "none")))).alias("section"))
    return fixed.join(counts, "section", "left").na.fill(0).unionByName(counts.join(fixed, "section", "left_anti"))


@query("""WITH t AS (SELECT c_mktsegment AS g, c_name AS v FROM customer WHERE c_custkey % 3 = 0), c AS (SELECT c_mktsegment AS g, c_name AS v FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment <> 'BUILDING')
SELECT g AS "group", v AS value, 'catalogue' AS source FROM c UNION ALL SELECT g, v, 'template' FROM t WHERE g NOT IN (SELECT g FROM c)""")
def reference_lists(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_mktsegment as group", "c_name as value", "c_custkey as k")
    return D.reference_lists(c.filter("k % 2 = 0 and group <> 'BUILDING'"), c.filter("k % 3 = 0"))


@query("""SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS customer, o_totalprice AS price, true AS checked FROM orders""")
def evolved_columns(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_custkey as owner", "cast(o_totalprice as string) as price")
    return P.evolve(o, {"owner": "customer"}, {"customer": "string", "price": "double"}, {"checked": F.lit(True)})


@query("""WITH e AS (SELECT l_orderkey AS file, l_linenumber % 2 AS sheet, l_quantity > 49 AS bad FROM lineitem) SELECT file, sheet, count(*) AS n_rows, count(*) FILTER (bad) AS n_errors, CASE WHEN count(*) FILTER (bad) > 0 THEN 'quantity too large' END AS first_error FROM e GROUP BY 1, 2""")
def sheet_results(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey as file", "l_linenumber % 2 as sheet", "l_linenumber as row_no", "l_quantity as quantity")
    errors = V.errors_of(rows, {"quantity": F.when(F.col("quantity") > 49, "quantity too large")}, ["file", "sheet"], "row_no")
    return V.unit_results(rows, errors, ["file", "sheet"])


@query("""WITH bad AS (SELECT DISTINCT l_orderkey AS f, l_linenumber % 2 AS s FROM lineitem WHERE l_quantity > 49) SELECT l_orderkey AS file, l_linenumber AS row_no FROM lineitem LEFT JOIN bad ON f = l_orderkey AND s = l_linenumber % 2 WHERE f IS NULL""")
def isolated_sheets(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey as file", "l_linenumber % 2 as sheet", "l_linenumber as row_no", "l_quantity as quantity")
    errors = V.errors_of(rows, {"quantity": F.when(F.col("quantity") > 49, "quantity too large")}, ["file", "sheet"], "row_no")
    return V.isolated(rows, errors, ["file", "sheet"]).select("file", "row_no")


@query(f"WITH {REL}, n AS (SELECT lower(s_name) AS name, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS domain_name, s_nationkey AS domain_id FROM supplier), t AS (SELECT lower('Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS name, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS domain_name, c_nationkey AS origin FROM customer) SELECT target AS domain_id, origin AS used_by, 'id' AS how FROM ed UNION SELECT domain_id, origin, 'name' FROM t JOIN n USING (name, domain_name)")
def reverse_relations(spark, sf):
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    names = s.select(C.fold(F.col("s_name")).alias("name"), F.expr("concat('NATION_', s_nationkey)").alias("domain_name"), F.col("s_nationkey").alias("domain_id"))
    texts = c.select(C.fold(F.expr("concat('Supplier#', lpad(cast(c_custkey as string), 9, '0'))")).alias("name"), F.expr("concat('NATION_', c_nationkey)").alias("domain_name"), F.col("c_nationkey").alias("origin"))
    return R.uses(links(spark, sf), names, texts)
