"""Queries of lookups, re-runs, link and plan overviews, explorer pages, glossary and wide staging columns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import graph as R
from ..operators import kpi as K
from ..operators import reconcile as M
from ..operators import repair as P
from ..operators import resolve as S
from ..sources import sheets
from . import merging, reports
from .registry import query, table


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 9 > 0 THEN c_nationkey END AS domain_id, CASE WHEN c_custkey % 9 = 0 THEN 'unknown value: nowhere' END AS error FROM customer")
def domain_lookup(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey")).selectExpr("c_custkey as k", "if(c_custkey % 9 = 0, 'nowhere', n_name) as name")
    told = S.controlled(c, "name", table(spark, sf, "nation"), "n_name", "n_nationkey", "domain_id")
    return told.select("k", "domain_id", F.col("domain_id_error").alias("error"))


@query("""WITH e AS (SELECT s_suppkey AS id, 'srv' || CAST(s_nationkey % 4 AS VARCHAR) AS server, s_name AS name FROM supplier WHERE s_suppkey % 3 = 0), v AS (SELECT DISTINCT 'srv' || CAST(s_nationkey % 4 AS VARCHAR) AS server, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_name END AS name FROM supplier),
f AS (SELECT v.* FROM v WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.server = v.server AND e.name IS NOT DISTINCT FROM v.name)) SELECT id, server, name, false AS created FROM e UNION ALL SELECT (SELECT max(id) FROM e) + row_number() OVER (ORDER BY server NULLS FIRST, name NULLS FIRST), server, name, true FROM f""")
def two_column_dimension(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("s_suppkey as id", "concat('srv', s_nationkey % 4) as server", "s_name as name")
    return S.get_or_create(s.withColumn("name", F.expr("if(id % 10 = 0, null, name)")), s.filter("id % 3 = 0"), ["server", "name"], "id")


@query(f"WITH {merging.BASE} SELECT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT k FROM plan)")
def unmatched_staging(spark, sf):
    return S.unmatched(table(spark, sf, "orders").selectExpr("o_orderkey as k"), merging.merge_plan(spark, sf), ["k"])


@query(f"WITH {merging.BASE} SELECT k, l_linenumber AS line FROM plan JOIN lineitem ON l_orderkey = k WHERE action = 'SKIP_DATE_REGRESSED'")
def skipped_keep_children(spark, sf):
    """Children of skipped parents stay active."""
    plan = merging.merge_plan(spark, sf)
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey * 10 as parent", "l_orderkey as k", "l_linenumber as line", "true as active", "cast(null as date) as end_date")
    kept = M.cascade(li, plan, "parent", merging.end()).filter("active")
    return kept.join(plan.filter(F.col("action") == M.SKIP).select("k"), "k", "left_semi").select("k", "line")


@query(f"WITH {merging.APPLIED} SELECT CASE WHEN action IN ('REPLACE', 'DELETE') THEN 'HISTORY' WHEN action = 'SKIP_DATE_REGRESSED' THEN action ELSE 'UNCHANGED' END AS action, count(*) AS n FROM applied GROUP BY 1")
def repeated_run(spark, sf):
    """The same load again, on what it left behind: nothing happens."""
    first = merging.scd_apply(spark, sf).drop("action").withColumn("id", F.coalesce("id", F.col("k") * 10 + 1))
    again = M.apply_versions(first, merging.incoming(spark, sf), ["domain", "k"], ["price", "prio"], merging.end())
    return again.groupBy("action").agg(F.count("*").alias("n"))


STATES = ("RESOLVED", "BROKEN", "INCONSISTENT", "NO_LINK")


@query(f"WITH {reports.REL} SELECT domain_id, {', '.join(f'''count(*) FILTER (state = '{s}') AS {s.lower()}''' for s in STATES)} FROM lk GROUP BY 1")
def link_status_by_origin(spark, sf):
    return R.states_by_origin(reports.links(spark, sf), STATES)


@query(f"WITH {reports.REL} SELECT 'state' AS field, state AS value, count(*) AS n FROM lk GROUP BY 2 UNION ALL SELECT 'type_id', coalesce(CAST(type_id AS VARCHAR), ''), count(*) FROM lk GROUP BY 2")
def link_counts(spark, sf):
    return R.counts_by(reports.links(spark, sf), "state", "type_id")


@query(f"WITH {reports.PEOPLE} SELECT regexp_replace(trim(lower(strip_accents(name))), '\\s+', ' ', 'g') AS person, coalesce(string_agg(DISTINCT CAST(role_id AS VARCHAR), ',' ORDER BY CAST(role_id AS VARCHAR)), '') AS roles, string_agg(DISTINCT CAST(domain AS VARCHAR), ',' ORDER BY CAST(domain AS VARCHAR)) AS areas FROM pp WHERE trim(name) <> '' GROUP BY 1")
def person_roles(spark, sf):
    who = reports.people(spark, sf).filter("trim(name) <> ''").withColumn("person", C.fold_spaces(F.col("name")))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",")
    return who.groupBy("person").agg(joined("role_id").alias("roles"), joined("domain").alias("areas"))


@query(f"WITH {reports.PLANS} " + " UNION ALL ".join(f"SELECT '{c}' AS grouping, coalesce(CAST({c} AS VARCHAR), '') AS value, count(*) AS n, count(*) FILTER (overdue) AS n_overdue FROM pr GROUP BY 2" for c in ("state", "bucket", "domain", "due")))
def plan_groupings(spark, sf):
    return K.groupings(reports.plans(spark, sf), ["state", "bucket", "domain", "due"])


CHOSEN = "priority IN ('1-URGENT', '5-LOW') AND status = 'O'"


@query(f"WITH {reports.EXPLORER}, f AS (SELECT * FROM x WHERE {CHOSEN}) SELECT k, domain, n_sources, (SELECT count(*) FROM f) AS n_rows, (SELECT count(DISTINCT domain) FROM f) AS n_domains, 'priority: 1-URGENT, 5-LOW; status: O' AS filters FROM f ORDER BY n_sources DESC, k LIMIT 50 OFFSET 50")
def explorer_page(spark, sf):
    page, header = K.explored(reports.explorer(spark, sf), {"priority": ["1-URGENT", "5-LOW"], "status": ["O"]}, [F.col("n_sources").desc(), F.col("k")], 2, 50)
    one = lambda df: df.withColumn("one", F.lit(1))  # noqa: E731  the header is one row
    return one(page.select("k", "domain", "n_sources")).join(one(header), "one").drop("one")


@query("SELECT p_partkey AS k, CASE WHEN upper(substr(p_name, 1, 1)) BETWEEN 'A' AND 'Z' THEN upper(substr(p_name, 1, 1)) ELSE '#' END AS letter, p_name AS term, row_number() OVER (PARTITION BY p_brand ORDER BY lower(p_name), p_partkey) AS place FROM part")
def glossary(spark, sf):
    w = Window.partitionBy("p_brand").orderBy(C.natural_key(C.fold(F.col("p_name"))), "p_partkey")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), C.initial(F.col("p_name")).alias("letter"), F.col("p_name").alias("term"), F.row_number().over(w).alias("place"))


@query("""WITH w AS (SELECT o_orderkey AS k, 'opened' AS name, CAST(o_orderdate AS DATE) AS day, CAST(NULL AS VARCHAR) AS error FROM orders WHERE o_orderkey % 3 > 0 UNION ALL SELECT o_orderkey, 'closed', CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END, CASE WHEN o_orderkey % 7 = 0 THEN 'later' END FROM orders) SELECT * FROM w""")
def wide_dates(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "if(o_orderkey % 3 = 0, ' ', date_format(o_orderdate, 'd/M/yyyy')) as opened", "if(o_orderkey % 7 = 0, 'later', date_format(o_orderdate, 'yyyy-MM-dd')) as closed")
    return P.unpivoted(o, ["k"], ["opened", "closed"], ("yyyy-MM-dd", "d/M/yyyy"))


@query("SELECT p_brand AS \"group\", CAST(p_partkey AS VARCHAR) || '. ' || p_name AS value FROM part WHERE p_partkey % 4 > 0 UNION ALL SELECT p_brand, CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 4 = 0")
def composite_values(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_brand as group", "cast(p_partkey as string) as code", "if(p_partkey % 4 = 0, ' ', p_name) as text")
    return p.select("group", C.join_present(". ", F.col("code"), F.col("text")).alias("value"))


@query("""SELECT code, n FROM (SELECT 'D' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS code, 1 AS n, c_nationkey AS d FROM customer) WHERE d NOT IN (3, 7) UNION ALL SELECT 'D3-' || CAST(s_suppkey AS VARCHAR), 2 FROM supplier WHERE s_nationkey = 3""")
def prefix_replace(spark, sf):
    current = table(spark, sf, "customer").selectExpr("concat('D', c_nationkey, '-', c_custkey) as code", "1 as n")
    batch = table(spark, sf, "supplier").filter("s_nationkey in (3, 4)").selectExpr("concat('D', s_nationkey, '-', s_suppkey) as code", "2 as n")
    touched = table(spark, sf, "nation").filter("n_nationkey in (3, 7)").selectExpr("concat('D', n_nationkey) as domain")
    return sheets.replace_slices(current, batch, touched, "code", by_prefix=True)
