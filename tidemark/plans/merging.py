"""Queries of reconciliation. Stand-ins: domain = nation of the customer, attribute = order, source = line item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reconcile as R
from .registry import parts, query, table

def end():
    return F.to_date(F.lit("1999-01-01"))


def orders(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("domain")), "o_custkey").select(
        F.col("o_orderkey").alias("k"), "domain", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("prio")
    )


def existing(spark, sf) -> DataFrame:
    return orders(spark, sf).filter("k % 5 <> 0").selectExpr("k", "domain", "k * 10 as id", "d as approval_date", "price", "prio")


def incoming(spark, sf) -> DataFrame:
    return orders(spark, sf).filter("k % 7 <> 0").selectExpr("k", "domain", "if(k % 11 = 0, null, date_add(d, cast(k % 3 - 1 as int))) as approval_date", "if(k % 4 = 0, price + 1, price) as price", "prio")


BASE = """
o AS (SELECT o_orderkey AS k, c_nationkey AS domain, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price, o_orderpriority AS prio FROM orders JOIN customer ON o_custkey = c_custkey),
old AS (SELECT k, domain, k * 10 AS id, d, price, prio FROM o WHERE k % 5 <> 0),
new AS (SELECT k, domain, CASE WHEN k % 11 = 0 THEN NULL ELSE d + CAST(k % 3 - 1 AS INTEGER) END AS d, CASE WHEN k % 4 = 0 THEN price + 1 ELSE price END AS price, prio FROM o WHERE k % 7 <> 0),
plan AS (SELECT coalesce(old.k, new.k) AS k, coalesce(old.domain, new.domain) AS domain, old.id AS existing_id, old.d AS old_date, new.d AS new_date, new.k AS in_k,
         old.price AS old_price, new.price AS new_price, old.prio AS prio, new.prio AS new_prio,
         CASE WHEN old.k IS NULL THEN 'INSERT' WHEN new.k IS NULL THEN 'DELETE' WHEN old.d IS NULL OR new.d IS NULL OR old.d = new.d THEN 'UPDATE'
              WHEN new.d > old.d THEN 'REPLACE' ELSE 'SKIP_DATE_REGRESSED' END AS action
         FROM old FULL JOIN new ON old.k = new.k AND old.domain = new.domain)
"""
COUNTS = ", ".join(f"CAST(count(*) FILTER (action = '{a}') AS BIGINT) AS {a.lower()}" for a in ("INSERT", "UPDATE", "REPLACE", "DELETE", "SKIP_DATE_REGRESSED"))


@query(f"WITH {BASE} SELECT domain, k, action, existing_id, old_date, new_date FROM plan")
def merge_plan(spark, sf):
    return R.merge_plan(existing(spark, sf), incoming(spark, sf), ["domain", "k"])


@query(f"WITH {BASE} SELECT domain, {COUNTS} FROM plan GROUP BY domain")
def merge_counts(spark, sf):
    return R.action_counts(merge_plan(spark, sf), ["domain"])


def current(spark, sf) -> DataFrame:
    return existing(spark, sf).selectExpr("id", "domain", "k", "price", "prio", "approval_date", "if(k % 9 = 0, null, cast(k % 13 as string)) as version", "true as active", "cast(null as date) as end_date")


APPLIED = BASE + """,
told AS (SELECT *, CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k % 13 AS VARCHAR) END AS version,
         CASE WHEN action = 'UPDATE' AND old_price = new_price AND prio = new_prio AND coalesce(new_date, old_date) IS NOT DISTINCT FROM old_date THEN 'UNCHANGED' ELSE action END AS what FROM plan),
applied AS (
  SELECT existing_id AS id, domain, k, CASE WHEN what = 'UPDATE' THEN new_price ELSE old_price END AS price, CASE WHEN what = 'UPDATE' THEN new_prio ELSE prio END AS prio,
         CASE WHEN what = 'UPDATE' THEN coalesce(new_date, old_date) ELSE old_date END AS approval_date, version, what NOT IN ('REPLACE', 'DELETE') AS active,
         CASE WHEN what IN ('REPLACE', 'DELETE') THEN DATE '1999-01-01' END AS end_date, what AS action FROM told WHERE what <> 'INSERT'
  UNION ALL
  SELECT NULL, domain, k, new_price, new_prio, new_date, CASE WHEN what = 'INSERT' OR version IS NULL THEN '1' ELSE CAST(CAST(version AS BIGINT) + 1 AS VARCHAR) END, true, NULL, what || '_NEW' FROM told WHERE what IN ('INSERT', 'REPLACE'))
"""


@query(f"WITH {APPLIED} SELECT * FROM applied")
def scd_apply(spark, sf):
    return R.apply_versions(current(spark, sf), incoming(spark, sf), ["domain", "k"], ["price", "prio"], end())


@query(f"WITH {APPLIED} SELECT CAST(77 AS BIGINT) AS id_load, domain, k, replace(action, '_NEW', '') AS action, version FROM applied WHERE action NOT IN ('UNCHANGED', 'REPLACE')")
def audit_log(spark, sf):
    return R.audit_lines(scd_apply(spark, sf), ["domain", "k"], F.lit(77).cast("bigint"))


@query(f"""WITH {APPLIED} SELECT domain, CAST(count(*) FILTER (active) AS BIGINT) AS n_active, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT k) FILTER (active) AS BIGINT) AS n_keys FROM applied GROUP BY domain""")
def scd_invariants(spark, sf):
    return scd_apply(spark, sf).groupBy("domain").agg(F.count_if("active").alias("n_active"), F.count("*").alias("n_rows"), F.count_distinct(F.when(F.col("active"), F.col("k"))).alias("n_keys"))


def children(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr("l_orderkey * 10 as parent_id", "l_linenumber as line", "l_linenumber % 4 <> 0 as active", "cast(null as date) as end_date").filter("parent_id % 50 <> 0")


CHILD = "c AS (SELECT l_orderkey * 10 AS parent_id, l_linenumber AS line, l_linenumber % 4 <> 0 AS was, p.action AS pa FROM lineitem LEFT JOIN plan p ON l_orderkey * 10 = p.existing_id AND p.action IN ('REPLACE', 'DELETE') WHERE (l_orderkey * 10) % 50 <> 0)"


@query(f"WITH {BASE}, {CHILD} SELECT parent_id, line, was AND pa IS NULL AS active, CASE WHEN was AND pa IS NOT NULL THEN DATE '1999-01-01' END AS end_date, false AS moves FROM c")
def scd_cascade(spark, sf):
    return R.cascade(children(spark, sf), merge_plan(spark, sf), "parent_id", end())


@query(f"""WITH {BASE}, {CHILD} SELECT CASE WHEN (was AND pa = 'REPLACE') THEN parent_id + 1 ELSE parent_id END AS parent_id, line, was AND (pa IS NULL OR pa = 'REPLACE') AS active,
       CASE WHEN was AND pa = 'DELETE' THEN DATE '1999-01-01' END AS end_date, coalesce(was AND pa = 'REPLACE', false) AS moves FROM c""")
def scd_reattach(spark, sf):
    plan = merge_plan(spark, sf)
    new = plan.filter("action = 'REPLACE'").select(F.col("existing_id").alias("old_id"), (F.col("existing_id") + 1).alias("new_id"))
    return R.reattach(R.cascade(children(spark, sf), plan, "parent_id", end(), follow=True), new, "parent_id")


@query("""WITH old AS (SELECT o_orderkey AS k, o_orderkey * 10 AS id, o_totalprice AS price, o_orderpriority AS prio FROM orders WHERE o_orderkey % 5 <> 0),
new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS prio FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(old.k, new.k) AS k, CASE WHEN old.k IS NULL THEN 'INSERT' WHEN new.k IS NULL THEN 'DELETE' WHEN old.price IS DISTINCT FROM new.price OR old.prio IS DISTINCT FROM new.prio THEN 'UPDATE' ELSE 'UNCHANGED' END AS action, id AS existing_id
FROM old FULL JOIN new ON old.k = new.k""")
def undated_merge(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter("o_orderkey % 5 <> 0").selectExpr("o_orderkey as k", "o_orderkey * 10 as id", "o_totalprice as price", "o_orderpriority as prio")
    new = o.filter("o_orderkey % 7 <> 0").selectExpr("o_orderkey as k", "if(o_orderkey % 4 = 0, o_totalprice + 1, o_totalprice) as price", "if(o_orderkey % 6 = 0, null, o_orderpriority) as prio")
    plan = R.undated_plan(old, new, ["k"])
    told = plan.join(old.select("k", F.struct("price", "prio").alias("a")), "k", "left").join(new.select("k", F.struct("price", "prio").alias("b")), "k", "left")
    differs = R.changed([F.col("a.price"), F.col("a.prio")], [F.col("b.price"), F.col("b.prio")])
    return told.select("k", F.when((F.col("action") == R.UPDATE) & ~differs, "UNCHANGED").otherwise(F.col("action")).alias("action"), "existing_id")


@query("""WITH old AS (SELECT l_orderkey AS ok, l_partkey AS pk, l_returnflag AS f, min(l_linenumber) AS id, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem WHERE l_linenumber % 3 <> 0 GROUP BY 1, 2, 3),
new AS (SELECT l_orderkey AS ok, l_partkey AS pk, CASE WHEN l_orderkey % 2 = 0 THEN 'X' ELSE l_returnflag END AS f, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem WHERE l_linenumber % 4 <> 0 GROUP BY 1, 2, 3),
s AS (SELECT ok, pk, sum(e) = 1 AND sum(i) = 1 AS single FROM (SELECT ok, pk, 1 AS e, 0 AS i FROM old UNION ALL SELECT ok, pk, 0, 1 FROM new) GROUP BY 1, 2),
o2 AS (SELECT old.*, CASE WHEN single THEN '' ELSE f END AS fk FROM old JOIN s USING (ok, pk)), n2 AS (SELECT new.*, CASE WHEN single THEN '' ELSE f END AS fk FROM new JOIN s USING (ok, pk))
SELECT coalesce(o2.ok, n2.ok) AS ok, coalesce(o2.pk, n2.pk) AS pk, coalesce(o2.fk, n2.fk) AS formula_key, CASE WHEN o2.ok IS NULL THEN 'INSERT' WHEN n2.ok IS NULL THEN 'DELETE' WHEN o2.d = n2.d THEN 'UPDATE' WHEN n2.d > o2.d THEN 'REPLACE' ELSE 'SKIP_DATE_REGRESSED' END AS action,
       o2.id AS existing_id, o2.d AS old_date, n2.d AS new_date
FROM o2 FULL JOIN n2 ON o2.ok = n2.ok AND o2.pk = n2.pk AND o2.fk = n2.fk""")
def conditional_pairing(spark, sf):
    rows = table(spark, sf, "lineitem")
    # both sides come from rows that lie by the base key
    li = rows.selectExpr("l_orderkey as ok", "l_partkey as pk", "l_returnflag as formula", "l_linenumber as line", "to_date(l_shipdate) as d").repartition(parts(rows), "ok", "pk")
    old = li.filter("line % 3 <> 0").groupBy("ok", "pk", "formula").agg(F.min("line").alias("id"), F.max("d").alias("approval_date"))
    new = li.filter("line % 4 <> 0").withColumn("formula", F.expr("if(ok % 2 = 0, 'X', formula)")).groupBy("ok", "pk", "formula").agg(F.max("d").alias("approval_date"))
    return R.pair_by_formula(old, new, ["ok", "pk"])


@query("""SELECT l_suppkey AS supp, l_partkey % 100 AS bin, count(*) AS n, count(DISTINCT CAST(l_shipdate AS DATE)) AS n_distinct, CASE WHEN count(DISTINCT CAST(l_shipdate AS DATE)) > 1 THEN 'CONFLICT' ELSE 'DUPLICATE' END AS verdict
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_rules(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_suppkey as supp", "l_partkey % 100 as bin", "to_date(l_shipdate) as d")
    return R.duplicate_rules(li, ["supp", "bin"], ["d"])


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def last_wins(spark, sf):
    return R.last_row(table(spark, sf, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query(f"WITH {BASE}, bad AS (SELECT DISTINCT domain FROM plan WHERE action = 'DELETE' AND k % 997 = 3) SELECT domain, {COUNTS} FROM plan WHERE domain NOT IN (SELECT domain FROM bad) GROUP BY domain")
def all_or_nothing(spark, sf):
    plan = merge_plan(spark, sf)
    return R.action_counts(R.without_failing_groups(plan, plan.filter("action = 'DELETE' and k % 997 = 3"), ["domain"]), ["domain"])


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN '1.0' WHEN o_orderkey % 9 = 2 THEN 'abc' ELSE CAST(o_orderkey % 13 AS VARCHAR) END AS version,
CASE WHEN o_orderkey % 9 <= 2 THEN '1' ELSE CAST(o_orderkey % 13 + 1 AS VARCHAR) END AS next_version FROM orders""")
def next_versions(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "case when o_orderkey % 9 = 0 then null when o_orderkey % 9 = 1 then '1.0' when o_orderkey % 9 = 2 then 'abc' else cast(o_orderkey % 13 as string) end as version")
    return o.withColumn("next_version", R.next_version(F.col("version")))


LINKS = """s AS (SELECT c_nationkey AS domain, c_custkey AS code, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'Supplier#' || lpad(CAST(c_custkey % 40 AS VARCHAR), 9, '0') END AS primary_name,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'NATION_' || CAST(c_custkey % 3 AS VARCHAR) END AS primary_domain, DATE '1998-01-01' + CAST(c_custkey % 2 AS INTEGER) AS d FROM customer),
g AS (SELECT c_nationkey AS domain, c_custkey AS code, c_custkey * 10 AS id, DATE '1998-01-01' AS d, CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 7 END AS primary_id, CASE WHEN c_custkey % 6 = 0 THEN CAST(0 AS INTEGER) END AS primary_domain_id FROM customer WHERE c_custkey % 10 <> 0),
t AS (SELECT s_name AS name, n_name AS domain_name, min(s_suppkey) AS target_id, min(s_nationkey) AS target_domain_id FROM supplier JOIN nation ON s_nationkey % 3 = n_nationkey GROUP BY 1, 2),
x AS (SELECT s.domain, s.code, g.id, s.d IS DISTINCT FROM g.d AS dates_differ, g.primary_id, g.primary_domain_id, t.target_id, t.target_domain_id,
  CASE WHEN primary_name IS NULL OR primary_domain IS NULL THEN 'NO_TEXT' WHEN g.id IS NULL THEN 'NOT_GOVERNED' WHEN g.primary_id IS NOT NULL AND g.primary_domain_id IS NOT NULL THEN 'ALREADY_LINKED'
  WHEN s.d IS DISTINCT FROM g.d THEN 'DATE_SKIPPED' WHEN t.target_id IS NULL THEN 'NO_MATCH'
  WHEN (g.primary_id IS NOT NULL AND g.primary_id IS DISTINCT FROM t.target_id) OR (g.primary_domain_id IS NOT NULL AND g.primary_domain_id IS DISTINCT FROM t.target_domain_id) THEN 'CONFLICT' ELSE 'RESOLVED' END AS outcome
  FROM s LEFT JOIN g ON s.domain = g.domain AND s.code = g.code LEFT JOIN t ON t.name = primary_name AND t.domain_name = primary_domain)"""


@query(f"WITH {LINKS} SELECT domain, code, id, outcome, dates_differ, CASE WHEN outcome = 'RESOLVED' THEN coalesce(primary_id, target_id) ELSE primary_id END AS primary_id, CASE WHEN outcome = 'RESOLVED' THEN coalesce(primary_domain_id, target_domain_id) ELSE primary_domain_id END AS primary_domain_id FROM x")
def link_completion(spark, sf):
    c, s, n = (table(spark, sf, t) for t in ("customer", "supplier", "nation"))
    staged = c.selectExpr("c_nationkey as domain", "c_custkey as code", "if(c_custkey % 8 = 0, null, concat('Supplier#', lpad(cast(c_custkey % 40 as string), 9, '0'))) as primary_name", "if(c_custkey % 9 = 0, null, concat('NATION_', c_custkey % 3)) as primary_domain", "date_add(date'1998-01-01', cast(c_custkey % 2 as int)) as approval_date")
    governed = c.filter("c_custkey % 10 <> 0").selectExpr("c_nationkey as domain", "c_custkey as code", "c_custkey * 10 as id", "date'1998-01-01' as approval_date", "if(c_custkey % 5 = 0, c_custkey % 7, null) as primary_id", "if(c_custkey % 6 = 0, 0, null) as primary_domain_id")
    targets = s.join(n, F.expr("s_nationkey % 3 = n_nationkey")).groupBy(F.col("s_name").alias("name"), F.col("n_name").alias("domain_name")).agg(F.min("s_suppkey").alias("target_id"), F.min("s_nationkey").alias("target_domain_id"))
    return R.complete_links(staged, governed, targets)
