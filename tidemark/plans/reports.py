"""Queries of change reports, relations, scores, explorer and plans, text search and intake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import diff as D
from ..operators import graph as G
from ..operators import kpi as K
from ..operators.paging import Pages
from ..operators.search import TextIndex
from ..sources import sheets
from ..sources.versions import Store
from ..streaming.intake import ROWS, intake
from .registry import query, table

SIDES = """b AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer WHERE c_custkey % 10 <> 0),
a AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN upper(c_name) ELSE c_name END AS name, CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 6 = 1 THEN 'X' ELSE c_mktsegment END AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer WHERE c_custkey % 13 <> 0)"""
FIELDS = ["name", "segment", "nation"]
CHANGED = SIDES + """, c AS (SELECT coalesce(b.k, a.k) AS k, b.k IS NULL AS fresh, a.k IS NULL AS gone, CAST((coalesce(b.name, '') <> coalesce(a.name, '')) AS INTEGER) + CAST((coalesce(b.segment, '') <> coalesce(a.segment, '')) AS INTEGER) AS n, coalesce(b.nation, a.nation) AS nation FROM b FULL JOIN a ON a.k = b.k),
ch AS (SELECT k, nation, CASE WHEN fresh THEN 'NEW' WHEN gone THEN 'REMOVED' WHEN n > 0 THEN 'MODIFIED' END AS change_type, CASE WHEN fresh OR gone THEN 0 ELSE n END AS n_fields FROM c)"""


def sides(spark, sf):
    c = table(spark, sf, "customer")
    before = c.filter("c_custkey % 10 <> 0").selectExpr("c_custkey as k", "c_name as name", "if(c_custkey % 4 = 0, null, c_mktsegment) as segment", "cast(c_nationkey as string) as nation")
    after = c.filter("c_custkey % 13 <> 0").selectExpr("c_custkey as k", "if(c_custkey % 7 = 0, upper(c_name), c_name) as name", "case when c_custkey % 4 = 0 then '' when c_custkey % 6 = 1 then 'X' else c_mktsegment end as segment", "cast(c_nationkey as string) as nation")
    return before, after


@query(f"WITH {CHANGED} SELECT k, change_type, n_fields FROM ch WHERE change_type IS NOT NULL")
def snapshot_diff(spark, sf):
    return D.changes(*sides(spark, sf), ["k"], FIELDS)


@query(f"WITH {SIDES} SELECT k, field, old, new FROM (SELECT b.k, 'name' AS field, coalesce(b.name, '') AS old, coalesce(a.name, '') AS new FROM b JOIN a ON a.k = b.k UNION ALL SELECT b.k, 'segment', coalesce(b.segment, ''), coalesce(a.segment, '') FROM b JOIN a ON a.k = b.k) WHERE old <> new")
def diff_fields(spark, sf):
    return D.field_changes(*sides(spark, sf), ["k"], FIELDS)


@query(f"""WITH {CHANGED} SELECT CAST(n_nationkey AS VARCHAR) AS nation, count(*) FILTER (change_type = 'NEW') AS new, count(*) FILTER (change_type = 'MODIFIED') AS modified, count(*) FILTER (change_type = 'REMOVED') AS removed FROM nation LEFT JOIN ch ON ch.nation = CAST(n_nationkey AS VARCHAR) GROUP BY 1""")
def diff_summary(spark, sf):
    b, a = sides(spark, sf)
    where = b.select("k", "nation").union(a.select("k", "nation")).distinct()
    return D.change_summary(D.changes(b, a, ["k"], FIELDS).join(where, "k"), table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("nation")), "nation")


@query("SELECT c_nationkey AS g, c_custkey AS k, rank, greatest(n - 5, 0) AS n_more FROM (SELECT c_nationkey, c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rank, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer) WHERE rank <= 5")
def report_rows(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_nationkey as g", "c_custkey as k", "c_acctbal")
    return D.first_rows(c, "g", [F.col("c_acctbal").desc(), F.col("k")], 5).drop("c_acctbal")


@query("SELECT name, CAST(row_number() OVER (ORDER BY CAST(replace(replace(name, 'NATION_', ''), 'Brand#', '') AS INTEGER) + CASE WHEN starts_with(name, 'NATION') THEN 1000 ELSE 0 END) AS INTEGER) AS place FROM (SELECT n_name AS name FROM nation UNION ALL SELECT DISTINCT p_brand FROM part)")
def natural_order(spark, sf):
    from pyspark.sql import Window

    names = table(spark, sf, "nation").select(F.col("n_name").alias("name")).union(table(spark, sf, "part").select("p_brand").distinct())
    # a bounded list of names: nations and brands
    return names.withColumn("place", F.row_number().over(Window.orderBy(C.chunk_key(F.col("name")))))


LISTS = """ls AS (SELECT s_nationkey AS g, s_suppkey AS k, s_suppkey % 4 AS kind, CASE s_suppkey % 4 WHEN 1 THEN upper(s_name) WHEN 2 THEN s_name || 'e' WHEN 3 THEN translate(CAST(s_suppkey AS VARCHAR), '0123456789', '!@#$%^&*()') || '=?=' ELSE s_name END AS value, s_name AS name FROM supplier WHERE s_nationkey <> 8 OR s_suppkey % 4 < 2),
cmp AS (SELECT g, value, CASE kind WHEN 1 THEN 'EQUIVALENT' WHEN 2 THEN 'TYPO' ELSE 'MISSING' END AS status, CASE WHEN kind < 3 THEN name END AS partner FROM ls WHERE kind > 0 AND g IN (SELECT g FROM ls WHERE kind < 3 AND g <> 7))"""


def compared(spark, sf):
    """Suppliers' names by nation, some in capitals, with a letter more, or of signs alone; one nation has no catalogue."""
    s = table(spark, sf, "supplier").filter("s_nationkey <> 8 or s_suppkey % 4 < 2")
    value = F.expr("case s_suppkey % 4 when 1 then upper(s_name) when 2 then concat(s_name, 'e') when 3 then concat(translate(cast(s_suppkey as string), '0123456789', '!@#$%^&*()'), '=?=') else s_name end")
    told = s.select(F.col("s_nationkey").alias("group"), value.alias("value"), F.col("s_suppkey").alias("pos"), "s_name")
    return D.compare_lists(told.select("group", "value", "pos"), told.filter("pos % 4 < 3 and group <> 7").select("group", F.col("s_name").alias("value")))


@query(f'WITH {LISTS} SELECT g AS "group", value, status, partner FROM cmp')
def compared_lists(spark, sf):
    return compared(spark, sf)


@query(f"""WITH {LISTS} SELECT g AS "group", value FROM cmp WHERE status = 'MISSING' AND g <> 3""")
def seed_values(spark, sf):
    """What the comparison misses, as candidates for simple catalogues."""
    return D.seed_candidates(compared(spark, sf), table(spark, sf, "nation").select(F.col("n_nationkey").alias("group")).filter("group <> 3"))


@query(f"""WITH {LISTS}, n AS (SELECT g, count(*) FILTER (status <> 'EQUIVALENT') AS d, count(*) FILTER (status = 'EQUIVALENT') AS e FROM cmp GROUP BY 1)
SELECT n_nationkey AS "group", coalesce(d, 0) AS n_differences, coalesce(e, 0) AS n_equivalent, CASE WHEN d > 0 THEN 'DIFFERENCES' WHEN e > 0 THEN 'SPELLING' ELSE 'OK' END AS state FROM nation LEFT JOIN n ON g = n_nationkey""")
def list_states(spark, sf):
    return D.list_states(compared(spark, sf), table(spark, sf, "nation").select(F.col("n_nationkey").alias("group")))


@query()
def fuzzy_lists(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("group"), F.col("p_name").alias("value"), F.col("p_partkey").alias("pos"), "p_size")
    odd = F.expr("case p_size % 5 when 0 then upper(value) when 1 then concat(value, 'e') when 2 then replace(value, 'e', 'é') when 3 then concat('zz', reverse(value)) else value end")
    return D.compare_lists(p.filter("pos % 3 <> 0").withColumn("value", odd).select("group", "value", "pos"), p.filter("pos % 2 = 0").select("group", "value"))


REL = """d AS (SELECT n_nationkey AS domain_id FROM nation WHERE n_nationkey <> 24), al AS (SELECT s_suppkey AS id, s_nationkey AS domain_id, s_suppkey % 11 <> 0 AS active FROM supplier),
ats AS (SELECT l_orderkey * 10 + l_linenumber AS id, c_nationkey AS domain_id, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_linenumber % 3 END AS type_id, CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN -1 ELSE l_suppkey END AS primary_id,
  CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_orderkey % 6 = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END AS primary_domain_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey),
lk AS (SELECT ats.id, ats.domain_id, ats.type_id, ats.primary_id, ats.primary_domain_id, CASE WHEN ats.primary_id IS NULL OR primary_domain_id IS NULL THEN 'NO_LINK' WHEN al.active IS NULL OR d.domain_id IS NULL THEN 'BROKEN' WHEN al.domain_id <> primary_domain_id THEN 'INCONSISTENT'
  WHEN primary_domain_id = ats.domain_id THEN 'SAME_DOMAIN' WHEN ats.type_id IS NULL THEN 'NO_TYPE' WHEN NOT al.active THEN 'TARGET_INACTIVE' ELSE 'RESOLVED' END AS state
  FROM ats LEFT JOIN al ON al.id = ats.primary_id LEFT JOIN d ON d.domain_id = primary_domain_id WHERE ats.type_id IS NOT NULL OR ats.primary_id IS NOT NULL),
ed AS (SELECT domain_id AS origin, primary_domain_id AS target, coalesce(CAST(type_id AS VARCHAR), 'No type') AS type, count(*) AS n, count(*) FILTER (state = 'TARGET_INACTIVE') AS n_inactive FROM lk WHERE state IN ('RESOLVED', 'TARGET_INACTIVE') GROUP BY 1, 2, 3)"""


def domains(spark, sf):
    return table(spark, sf, "nation").filter("n_nationkey <> 24").select(F.col("n_nationkey").alias("domain_id"))


def links(spark, sf):
    li, o, c, s = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "supplier"))
    at = li.join(o, F.expr("l_orderkey = o_orderkey")).join(c, F.expr("c_custkey = o_custkey")).join(s, F.expr("s_suppkey = l_suppkey")).selectExpr(
        "l_orderkey * 10 + l_linenumber as id", "c_nationkey as domain_id", "if(l_linenumber % 5 = 0, null, l_linenumber % 3) as type_id", "case when l_orderkey % 7 = 0 then null when l_orderkey % 17 = 0 then -1 else l_suppkey end as primary_id",
        "case when l_orderkey % 9 = 0 then null when l_orderkey % 6 = 0 then (s_nationkey + 1) % 25 else s_nationkey end as primary_domain_id",
    )
    return G.link_states(at, domains(spark, sf), s.selectExpr("s_suppkey as id", "s_nationkey as domain_id", "s_suppkey % 11 <> 0 as active"))


@query(f"WITH {REL} SELECT * FROM lk")
def link_states(spark, sf):
    return links(spark, sf)


@query(f"WITH {REL} SELECT * FROM ed")
def edges(spark, sf):
    return G.edges(links(spark, sf))


@query(f"""WITH {REL}, seen AS (SELECT domain_id FROM lk UNION SELECT primary_domain_id FROM lk WHERE primary_domain_id IS NOT NULL), e AS (SELECT domain_id, true AS known FROM d UNION ALL SELECT domain_id, false FROM seen WHERE domain_id NOT IN (SELECT domain_id FROM d))
SELECT e.domain_id, known, (SELECT count(DISTINCT target) FROM ed WHERE origin = e.domain_id) AS n_out, (SELECT count(DISTINCT origin) FROM ed WHERE target = e.domain_id) AS n_in, (SELECT count(*) FROM lk WHERE lk.domain_id = e.domain_id AND state NOT IN ('RESOLVED', 'TARGET_INACTIVE')) AS n_unresolved FROM e""")
def nodes_degree(spark, sf):
    return G.nodes(domains(spark, sf), links(spark, sf))


@query(f"""WITH {REL} SELECT count(*) AS n_links, count(*) FILTER (state IN ('RESOLVED', 'TARGET_INACTIVE')) AS n_drawn, (SELECT count(DISTINCT (origin, target)) FROM ed) AS n_pairs, {', '.join(f"count(*) FILTER (state = '{s}') AS {s.lower()}" for s in ('RESOLVED', 'TARGET_INACTIVE', *G.PROBLEM_ORDER))},
(SELECT count(*) FROM d) AS n_domains, (SELECT count(*) FROM (SELECT origin FROM ed UNION SELECT target FROM ed)) AS n_related FROM lk""")
def graph_summary(spark, sf):
    return G.summary(domains(spark, sf), links(spark, sf))


@query(f"WITH {REL} SELECT *, CAST(CASE state WHEN 'BROKEN' THEN 1 WHEN 'INCONSISTENT' THEN 2 WHEN 'NO_LINK' THEN 3 WHEN 'NO_TYPE' THEN 4 WHEN 'SAME_DOMAIN' THEN 5 END AS INTEGER) AS priority FROM lk WHERE state NOT IN ('RESOLVED', 'TARGET_INACTIVE')")
def graph_problems(spark, sf):
    return G.problems(links(spark, sf))


@query(f"WITH {REL} SELECT id, domain_id, type_id, primary_id, primary_domain_id, CASE WHEN primary_domain_id % 10 = 0 THEN 'DOMAIN_INACTIVE' ELSE state END AS state FROM lk WHERE domain_id % 10 <> 0")
def inactive_rewrite(spark, sf):
    return G.without_inactive(links(spark, sf), table(spark, sf, "nation").filter("n_nationkey % 10 = 0").select(F.col("n_nationkey").alias("domain_id")))


@query(f"WITH {REL} SELECT CASE WHEN origin = 3 THEN target ELSE origin END AS neighbour, CAST(sum(CASE WHEN origin = 3 THEN n ELSE 0 END) AS BIGINT) AS n_out, CAST(sum(CASE WHEN origin <> 3 THEN n ELSE 0 END) AS BIGINT) AS n_in, CAST(sum(n) AS BIGINT) AS n FROM ed WHERE n >= 2 AND (origin = 3 OR target = 3) GROUP BY 1")
def neighbourhood(spark, sf):
    return G.Neighbourhoods(edges(spark, sf), links(spark, sf)).neighbours(3, 2)


@query(f"WITH {REL} SELECT id, primary_id, primary_domain_id, state, CAST(CASE state WHEN 'BROKEN' THEN 1 WHEN 'INCONSISTENT' THEN 2 WHEN 'NO_LINK' THEN 3 WHEN 'NO_TYPE' THEN 4 WHEN 'SAME_DOMAIN' THEN 5 END AS INTEGER) AS priority FROM lk WHERE domain_id = 3")
def declared_links(spark, sf):
    return G.Neighbourhoods(edges(spark, sf), links(spark, sf)).attributes(3)


@query(f"""WITH {REL}, own AS (SELECT count(*) AS n_declared, count(*) FILTER (state IN ('RESOLVED', 'TARGET_INACTIVE')) AS n_drawn, count(*) FILTER (state NOT IN ('RESOLVED', 'TARGET_INACTIVE')) AS n_problems FROM lk WHERE domain_id = 3)
SELECT *, (SELECT count(DISTINCT target) FROM ed WHERE origin = 3) AS n_targets, (SELECT count(DISTINCT origin) FROM ed WHERE target = 3) AS n_sources, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM ed WHERE target = 3) AS n_used,
CASE WHEN n_declared > 0 THEN round_even(100 * n_drawn / n_declared, 1) END AS drawn_share FROM own""")
def neighbourhood_measures(spark, sf):
    return G.Neighbourhoods(edges(spark, sf), links(spark, sf)).measures(3)


ATT = """ats AS (SELECT c_nationkey AS domain, o_orderkey AS k, o_orderpriority IN ('1-URGENT', '2-HIGH') AS critical, o_orderstatus = 'P' AS structure, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48) AS has_source FROM orders JOIN customer ON o_custkey = c_custkey),
pe AS (SELECT *, CASE WHEN has_source THEN 'none' WHEN critical AND structure THEN 'critical_structure' WHEN critical THEN 'critical' ELSE 'other' END AS category FROM ats), pt AS (SELECT *, CASE category WHEN 'critical_structure' THEN 5 WHEN 'critical' THEN 3 WHEN 'other' THEN 1 ELSE 0 END AS points FROM pe),
g AS (SELECT domain, count(*) AS n_attributes, CAST(sum(points) AS BIGINT) AS penalty, count(*) FILTER (category = 'critical_structure') AS n_critical_structure, count(*) FILTER (category = 'critical') AS n_critical, count(*) FILTER (category = 'other') AS n_other, count(*) FILTER (critical) AS n_all_critical,
  count(*) FILTER (critical AND has_source) AS n_covered_critical, count(*) FILTER (has_source) AS n_covered FROM pt GROUP BY 1),
sc AS (SELECT n_nationkey AS domain, coalesce(n_attributes, 0) AS n_attributes, coalesce(penalty, 0) AS penalty, coalesce(n_critical_structure, 0) AS n_critical_structure, coalesce(n_critical, 0) AS n_critical, coalesce(n_other, 0) AS n_other, coalesce(n_all_critical, 0) AS n_all_critical, coalesce(n_covered_critical, 0) AS n_covered_critical,
  coalesce(n_covered, 0) AS n_covered, CASE WHEN penalty IS NOT NULL THEN greatest(0, 100 - penalty) END AS score, round_even(100 * n_covered / n_attributes, 1) AS coverage, CASE WHEN n_all_critical > 0 THEN round_even(100 * n_covered_critical / n_all_critical, 1) END AS critical_coverage FROM nation LEFT JOIN g ON domain = n_nationkey)"""


def attributes(spark, sf):
    o, c, li = (table(spark, sf, t) for t in ("orders", "customer", "lineitem"))
    sourced = li.filter("l_quantity > 48").select(F.col("l_orderkey").alias("k")).distinct().withColumn("s", F.lit(True))
    rows = o.join(c, F.expr("o_custkey = c_custkey")).selectExpr("c_nationkey as domain", "o_orderkey as k", "o_orderpriority in ('1-URGENT', '2-HIGH') as critical", "o_orderstatus = 'P' as structure")
    return rows.join(sourced, "k", "left").withColumn("has_source", F.coalesce("s", F.lit(False))).drop("s")


def score_rows(spark, sf):
    return K.domain_scores(attributes(spark, sf), table(spark, sf, "nation").select(F.col("n_nationkey").alias("domain")))


@query(f"WITH {ATT} SELECT * FROM sc")
def domain_score(spark, sf):
    return score_rows(spark, sf)


@query(f"WITH {ATT} SELECT domain, k, critical, structure, has_source, category, points FROM pt WHERE points > 0")
def penalised_list(spark, sf):
    return K.penalised(attributes(spark, sf))


@query(f"WITH {ATT} SELECT count(*) AS n_domains, count(score) AS n_evaluated, round_even(avg(score), 1) AS mean_score, CAST(sum(n_attributes) AS BIGINT) AS n_attributes, CAST(sum(penalty) AS BIGINT) AS penalty, count(*) FILTER (score >= 90) AS n_good, round_even(100 * sum(n_covered) / sum(n_attributes), 1) AS coverage FROM sc")
def portfolio(spark, sf):
    return K.portfolio(score_rows(spark, sf))


PEOPLE = """pp AS (SELECT s_nationkey AS domain, CAST(CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_suppkey % 6 END AS INTEGER) AS role_id, CASE WHEN s_suppkey % 20 = 0 THEN NULL WHEN s_suppkey % 20 = 1 THEN ' ' ELSE CASE s_suppkey % 4 WHEN 0 THEN 'Ana  López ' WHEN 1 THEN 'ANA LOPEZ' WHEN 2 THEN 'Ana Lopez' ELSE 'Person ' || CAST(s_suppkey % 17 AS VARCHAR) END END AS name FROM supplier)"""


def people(spark, sf):
    return table(spark, sf, "supplier").selectExpr("s_nationkey as domain", "cast(if(s_suppkey % 6 = 5, null, s_suppkey % 6) as int) as role_id", "case when s_suppkey % 20 = 0 then null when s_suppkey % 20 = 1 then ' ' else case s_suppkey % 4 when 0 then 'Ana  López ' when 1 then 'ANA LOPEZ' when 2 then 'Ana Lopez' else concat('Person ', s_suppkey % 17) end end as name")


@query(f"""WITH {PEOPLE} SELECT n_nationkey AS domain, concat_ws(',', {', '.join(f"CASE WHEN NOT EXISTS (SELECT 1 FROM pp WHERE pp.domain = n_nationkey AND role_id = {r}) THEN '{r}' END" for r in K.REQUIRED_ROLES)}) AS missing_roles,
(SELECT count(DISTINCT role_id) FROM pp WHERE pp.domain = n_nationkey AND role_id BETWEEN 1 AND 4) = 4 AS complete FROM nation""")
def role_completeness(spark, sf):
    return K.missing_roles(people(spark, sf), table(spark, sf, "nation").select(F.col("n_nationkey").alias("domain")))


ROLES = ", ".join(f"coalesce(string_agg(DISTINCT name, ' | ' ORDER BY name) FILTER (role_id = {r}), '') AS role_{r}" for r in K.REQUIRED_ROLES)


@query(f"WITH {PEOPLE} SELECT domain, {ROLES}, coalesce(string_agg(DISTINCT name, ' | ' ORDER BY name) FILTER (role_id IS NULL OR role_id NOT BETWEEN 1 AND 4), '') AS other_roles FROM pp GROUP BY 1")
def role_pivot(spark, sf):
    return K.role_columns(people(spark, sf))


@query(f"""WITH {PEOPLE}, nm AS (SELECT *, regexp_replace(trim(lower(strip_accents(name))), '\\s+', ' ', 'g') AS person FROM pp WHERE trim(name) <> ''), sp AS (SELECT person, name, count(*) AS n FROM nm GROUP BY 1, 2),
best AS (SELECT person, name AS spelling FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY n DESC, (CASE WHEN name LIKE '%ó%' THEN 1 ELSE 0 END) DESC, (upper(name) <> name AND lower(name) <> name) DESC, name DESC) AS r FROM sp) WHERE r = 1)
SELECT person, spelling, (SELECT CAST(sum(n) AS BIGINT) FROM sp WHERE sp.person = best.person) AS n_assignments, (SELECT count(DISTINCT domain) FROM nm WHERE nm.person = best.person) AS n_domains, (SELECT string_agg(DISTINCT CAST(domain AS VARCHAR), ',' ORDER BY CAST(domain AS VARCHAR)) FROM nm WHERE nm.person = best.person) AS domains FROM best""")
def person_grouping(spark, sf):
    return K.persons(people(spark, sf))


@query(f"""WITH {PEOPLE}, n AS (SELECT regexp_replace(trim(lower(strip_accents(name))), '\\s+', ' ', 'g') AS person, count(DISTINCT domain) AS v FROM pp WHERE trim(name) <> '' GROUP BY 1), s AS (SELECT unnest(range(1, (SELECT max(v) FROM n) + 1)) AS value) SELECT value, count(v) AS n FROM s LEFT JOIN n ON v = value GROUP BY 1""")
def gap_histogram(spark, sf):
    return K.gap_histogram(K.persons(people(spark, sf)), "n_domains")


EXPLORER = """x AS (SELECT o_orderkey AS k, c_nationkey AS domain, o_orderpriority AS priority, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN '' ELSE c_mktsegment END AS segment, o_orderstatus AS status, count(l_orderkey) AS n_sources, coalesce(string_agg(CAST(l_suppkey AS VARCHAR), '; ' ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR)), '') AS sources
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"""


def explorer(spark, sf):
    o, c, li = (table(spark, sf, t) for t in ("orders", "customer", "lineitem"))
    joined = K.joined_texts(li.selectExpr("l_orderkey as k", "l_linenumber as line", "cast(l_suppkey as string) as supp"), ["k"], ["line"], "supp").selectExpr("k", "texts as sources", "n as n_sources")
    rows = o.join(c, F.expr("o_custkey = c_custkey")).selectExpr("o_orderkey as k", "c_nationkey as domain", "o_orderpriority as priority", "case when o_orderkey % 10 = 0 then null when o_orderkey % 10 = 1 then '' else c_mktsegment end as segment", "o_orderstatus as status")
    return rows.join(joined, "k", "left").na.fill(0, ["n_sources"]).na.fill("", ["sources"])


@query(f"WITH {EXPLORER} SELECT * FROM x")
def explorer_rows(spark, sf):
    return explorer(spark, sf)


@query(f"WITH {EXPLORER} SELECT field, value, count(*) AS n FROM (SELECT 'priority' AS field, coalesce(priority, '') AS value FROM x UNION ALL SELECT 'segment', coalesce(segment, '') FROM x UNION ALL SELECT 'status', coalesce(status, '') FROM x) GROUP BY 1, 2")
def facets(spark, sf):
    return K.facets(explorer(spark, sf), ["priority", "segment", "status"])


@query(f"WITH {EXPLORER} SELECT * FROM x WHERE priority IN ('1-URGENT', '5-LOW') AND coalesce(segment, '') IN ('', 'BUILDING') AND contains(lower(concat_ws(' ', priority, segment, status)), 'low') AND contains(lower(concat_ws(' ', priority, segment, status)), 'o')")
def explorer_query(spark, sf):
    found = K.faceted(explorer(spark, sf), {"priority": ["1-URGENT", "5-LOW"], "segment": ["", "BUILDING"]})
    return K.text_search(found, "LÓW o", ["priority", "segment", "status"])


@query("SELECT o_orderkey AS k, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200")
def page(spark, sf):
    return K.page(table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_totalprice as price"), [F.col("price").desc(), F.col("k")], 3)


@query("SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, l_extendedprice AS price FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 5 OFFSET 5 * (least(10000, (SELECT greatest(1, CAST(ceil(count(*) / 5.0) AS BIGINT)) FROM lineitem)) - 1)")
def deep_page(spark, sf):
    """The ten thousandth page of all line items, or the last one."""
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_linenumber as line", "l_partkey as part", "l_extendedprice as price")
    return Pages(li, [F.col("price").desc(), F.col("k"), F.col("line"), F.col("part")]).page(10_000, 5)


PLANS = """pl AS (SELECT o_orderkey AS k, c_nationkey AS domain, CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(o_orderkey % 21 * 5 AS INTEGER) END AS progress, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS due, CASE o_orderstatus WHEN 'F' THEN 'Finalizado' WHEN 'P' THEN 'En proceso' ELSE 'Alertado' END AS state,
CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey END AS live_id, o_orderkey % 4 <> 0 AS linked_active FROM orders JOIN customer ON o_custkey = c_custkey),
pr AS (SELECT *, CASE WHEN progress IS NULL THEN 'no data' WHEN progress <= 0 THEN '0 %' WHEN progress <= 25 THEN '1-25 %' WHEN progress <= 50 THEN '26-50 %' WHEN progress <= 75 THEN '51-75 %' WHEN progress < 100 THEN '76-99 %' ELSE '100 %' END AS bucket, coalesce(due < DATE '1999-01-01' AND state <> 'Finalizado', false) AS overdue, live_id IS NULL AS without_live_attribute, live_id IS NOT NULL AND NOT linked_active AS previous_version FROM pl)"""


def plans(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey as k", "c_nationkey as domain", "cast(if(o_orderkey % 12 = 0, null, o_orderkey % 21 * 5) as int) as progress", "if(o_orderkey % 7 = 0, null, to_date(o_orderdate)) as due",
        "case o_orderstatus when 'F' then 'Finalizado' when 'P' then 'En proceso' else 'Alertado' end as state", "if(o_orderkey % 9 = 0, null, o_orderkey) as live_id", "o_orderkey % 4 <> 0 as linked_active",
    )
    return K.plan_rows(rows, F.to_date(F.lit("1999-01-01")))


@query(f"WITH {PLANS} SELECT * FROM pr")
def overdue(spark, sf):
    return plans(spark, sf)


KPI = "count(*) AS n_plans, count(DISTINCT domain) AS n_domains, CAST(floor(avg(progress) + 0.5) AS BIGINT) AS mean_progress, count(*) FILTER (state = 'Finalizado') AS n_finished, count(*) FILTER (overdue) AS n_overdue, count(*) FILTER (previous_version) AS n_previous_version, count(*) FILTER (without_live_attribute) AS n_without_live"


@query(f"WITH {PLANS} SELECT {KPI} FROM pr")
def plan_kpis(spark, sf):
    return K.plan_kpis(plans(spark, sf))


@query(f"WITH {PLANS} SELECT bucket, {KPI} FROM pr GROUP BY bucket")
def plan_buckets(spark, sf):
    return K.plan_kpis(plans(spark, sf), "bucket")


STATE = "st AS (SELECT n_nationkey AS domain, CASE n_nationkey % 4 WHEN 0 THEN 'Activo' WHEN 1 THEN 'Activo' WHEN 2 THEN 'Inactivo' ELSE 'Confidencial' END AS state_class FROM nation WHERE n_nationkey <> 5)"


def states(spark, sf):
    return table(spark, sf, "nation").filter("n_nationkey <> 5").select(F.col("n_nationkey").alias("domain"), C.state_class(F.element_at(F.array(F.lit("ACTIVO"), F.lit(None), F.lit("Inactivo "), F.lit("restringido")), F.col("n_nationkey") % 4 + 1)).alias("state_class"))


@query(f"WITH {EXPLORER}, {STATE} SELECT k, x.domain, priority, segment, status, n_sources, CASE WHEN state_class = 'Confidencial' THEN '(confidential)' ELSE sources END AS sources, state_class FROM x JOIN st ON st.domain = x.domain WHERE state_class <> 'Inactivo'")
def masked_publication(spark, sf):
    return K.publish(explorer(spark, sf), states(spark, sf), ["sources"])


@query(f"WITH {STATE}, c AS (SELECT state_class, count(*) AS n FROM customer LEFT JOIN st ON domain = c_nationkey GROUP BY 1), s AS (SELECT state_class, count(*) AS n FROM supplier LEFT JOIN st ON domain = s_nationkey GROUP BY 1) SELECT 'customers' AS entity, CAST(coalesce((SELECT sum(n) FROM c WHERE state_class = 'Inactivo'), 0) AS BIGINT) AS n_inactive_domain, CAST(coalesce((SELECT sum(n) FROM c WHERE state_class IS NULL), 0) AS BIGINT) AS n_unknown_domain UNION ALL SELECT 'suppliers', CAST(coalesce((SELECT sum(n) FROM s WHERE state_class = 'Inactivo'), 0) AS BIGINT), CAST(coalesce((SELECT sum(n) FROM s WHERE state_class IS NULL), 0) AS BIGINT)")
def dropped_rows(spark, sf):
    return K.dropped_rows(states(spark, sf), customers=table(spark, sf, "customer").select(F.col("c_nationkey").alias("domain")), suppliers=table(spark, sf, "supplier").select(F.col("s_nationkey").alias("domain")))


@query("SELECT doc_id AS k FROM documents WHERE contains(lower(strip_accents(concat_ws(' ', source, text))), 'src1') AND contains(lower(strip_accents(concat_ws(' ', source, text))), 'eau')")
def text_search(spark, sf):
    return K.text_search(table(spark, sf, "documents"), "SRC1 éau", ["source", "text"]).select(F.col("doc_id").alias("k"))


ASKED = {"SRC1 éau": ("src1", "eau"), "là THE": ("la", "the"), "zz%": ("zz%",)}


@query(" UNION ALL ".join("SELECT '{}' AS query, doc_id AS k FROM documents WHERE {}".format(q, " AND ".join(f"contains(lower(strip_accents(concat_ws(' ', source, text))), '{w}')" for w in words)) for q, words in ASKED.items()))
def indexed_search(spark, sf):
    """Several searches over one table of runs of letters."""
    index = TextIndex(table(spark, sf, "documents"), "doc_id", ["source", "text"])
    found = [index.search(q).select(F.lit(q).alias("query"), F.col("id").alias("k")) for q in ASKED]
    return reduce(DataFrame.unionByName, found)


@query("SELECT doc_id AS k FROM documents WHERE contains(lower(coalesce(source, '')), 'src12') OR contains(lower(coalesce(lang, '')), 'fr')")
def any_field_search(spark, sf):
    d = table(spark, sf, "documents")
    return K.any_field(d, "SRC12", ["source"]).union(K.any_field(d, "FR", ["lang"])).select(F.col("doc_id").alias("k")).distinct()


@query("SELECT CASE WHEN upper(strip_accents(substr(text, 1, 1))) BETWEEN 'A' AND 'Z' THEN upper(strip_accents(substr(text, 1, 1))) ELSE '#' END AS letter, count(*) AS n FROM documents GROUP BY 1")
def glossary_index(spark, sf):
    return table(spark, sf, "documents").groupBy(C.initial(F.substring("text", 1, 1)).alias("letter")).agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_intake(spark, sf):
    """Events through the folder intake, until all are there: the same rows as a batch read gives."""
    root = sheets.shared_folder(spark)
    columns = ["event_id", "user_id", "event_type", "value"]
    table(spark, sf, "events").select(*columns).repartition(8, "event_id").write.parquet(f"{root}/arriving")
    q = intake(spark, f"{root}/arriving", "event_id bigint, user_id bigint, event_type string, value double", f"{root}/taken", f"{root}/checkpoint", files_per_batch=3)
    q.awaitTermination()
    return Store(spark, f"{root}/taken").read(ROWS).select(*columns)
