"""Queries of resolution, cleaning, validation, repairs, gates and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import gates as G
from ..operators import repair as P
from ..operators import resolve as S
from ..operators import validate as V
from ..sources import sheets
from .registry import query, table


@query("""SELECT c_custkey AS k, c_mktsegment AS segment, id AS segment_id, CASE WHEN c_mktsegment IS NOT NULL AND id IS NULL THEN 'unknown value: ' || c_mktsegment END AS segment_id_error
FROM customer LEFT JOIN (SELECT upper(seg) AS seg, min(id) AS id FROM (SELECT c_mktsegment AS seg, min(c_custkey) AS id FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1) GROUP BY 1) ON upper(c_mktsegment) = seg""")
def controlled_lookup(spark, sf):
    c = table(spark, sf, "customer")
    catalogue = c.filter("c_mktsegment <> 'MACHINERY'").groupBy(F.lower("c_mktsegment").alias("seg")).agg(F.min("c_custkey").alias("id"))
    return S.controlled(c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment")), "segment", catalogue, "seg", "id", "segment_id")


@query("""SELECT p_partkey AS k, p_brand AS a, p_type AS b, p_size % 3 AS c, t.id AS class_id, CASE WHEN p_brand IS NOT NULL AND t.id IS NULL THEN p_brand || '/' || p_type || '/' || CAST(p_size % 3 AS VARCHAR) END AS class_id_error
FROM part LEFT JOIN (SELECT p_brand AS x, p_type AS y, p_size % 3 AS z, min(p_partkey) AS id FROM part WHERE p_size % 2 = 0 GROUP BY 1, 2, 3) t ON p_brand = x AND p_type = y AND p_size % 3 = z""")
def composite_lookup(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey as k", "p_brand as a", "p_type as b", "p_size % 3 as c", "p_size")
    catalogue = p.filter("p_size % 2 = 0").groupBy(F.col("a").alias("x"), F.col("b").alias("y"), F.col("c").alias("z")).agg(F.min("k").alias("id"))
    return S.composite(p.drop("p_size"), ["a", "b", "c"], catalogue, ["x", "y", "z"], "id", "class_id")


@query("""SELECT s_suppkey AS k, r.id AS region_id, n.id AS nation_id, CASE WHEN r.id IS NULL THEN 'region' WHEN n.id IS NULL THEN 'nation' END AS failed_level
FROM (SELECT s_suppkey, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS nation, CASE WHEN s_suppkey % 7 = 0 THEN 'NOWHERE' ELSE r_name END AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = (n_regionkey + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END) % 5)
LEFT JOIN (SELECT r_name, r_regionkey AS id FROM region) r ON region = r.r_name LEFT JOIN (SELECT n_name, n_regionkey, n_nationkey AS id FROM nation) n ON nation = n_name AND n.n_regionkey = r.id""")
def chain_lookup(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    base = s.join(n, F.expr("s_nationkey = n_nationkey")).join(r, F.expr("r_regionkey = (n_regionkey + if(s_suppkey % 5 = 0, 1, 0)) % 5"))
    base = base.selectExpr("s_suppkey as k", "concat('NATION_', s_nationkey) as nation", "if(s_suppkey % 7 = 0, 'NOWHERE', r_name) as region")
    found = S.chain(base, [("region", r.selectExpr("r_name", "r_regionkey as region_id"), "r_name", "region_id", None), ("nation", n.selectExpr("n_name", "n_nationkey as nation_id", "n_regionkey as up"), "n_name", "nation_id", "up")])
    return found.select("k", "region_id", "nation_id", "failed_level")


CREATED = """servers AS (SELECT n_nationkey + 1 AS server_id, n_name AS server FROM nation WHERE n_nationkey < 20),
fresh AS (SELECT (SELECT max(server_id) FROM servers) + row_number() OVER (ORDER BY n_name) AS server_id, n_name AS server FROM (SELECT DISTINCT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey >= 20)),
dbs AS (SELECT server_id * 10 + length(segment) AS db_id, server_id AS up, segment AS db FROM servers, (SELECT DISTINCT c_mktsegment AS segment FROM customer) WHERE (server_id + length(segment)) % 3 <> 0),
tabs AS (SELECT db_id * 10 + t AS table_id, db_id AS up, 'table ' || t AS tab, (db_id + t) % 4 <> 0 AS active FROM dbs, (SELECT unnest(range(6)) AS t))"""


@query(f"""WITH {CREATED}, c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 17 <> 0 THEN n_name END AS server, c_mktsegment AS db, 'table ' || (c_custkey % 7) AS tab FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT k, s.server_id, d.db_id, t.table_id, CASE WHEN s.server_id IS NULL THEN 'server' WHEN d.db_id IS NULL THEN 'db' WHEN t.table_id IS NULL OR NOT active THEN 'tab' END AS failed_level,
CASE WHEN t.table_id IS NULL THEN 'unknown' WHEN NOT active THEN 'inactive' END AS reason
FROM c LEFT JOIN (SELECT * FROM servers UNION ALL SELECT * FROM fresh) s ON s.server = c.server LEFT JOIN dbs d ON d.up = s.server_id AND d.db = c.db LEFT JOIN tabs t ON t.up = d.db_id AND t.tab = c.tab""")
def created_chain(spark, sf):
    """Servers are made where they lack, databases and tables must be there, tables active too."""
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    servers = n.filter("n_nationkey < 20").selectExpr("n_nationkey + 1 as server_id", "n_name as server_name")
    pairs = servers.withColumn("segment", F.explode(c.agg(F.collect_set("c_mktsegment")).scalar()))
    dbs = pairs.filter("(server_id + length(segment)) % 3 <> 0").selectExpr("server_id * 10 + length(segment) as db_id", "server_id as db_up", "segment as db_name")
    tabs = dbs.select("db_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("t")).selectExpr("db_id * 10 + t as table_id", "db_id as tab_up", "concat('table ', t) as tab_name", "(db_id + t) % 4 <> 0 as active")
    rows = c.join(n, F.expr("c_nationkey = n_nationkey")).selectExpr("c_custkey as k", "if(c_custkey % 17 <> 0, n_name, null) as server", "c_mktsegment as db", "concat('table ', c_custkey % 7) as tab")
    told, _ = S.created_chain(rows, ("server", servers, "server_name", "server_id"), [("db", dbs, "db_name", "db_id", "db_up", None), ("tab", tabs, "tab_name", "table_id", "tab_up", "active")])
    return told.select("k", "server_id", "db_id", "table_id", "failed_level", "reason")


@query("""WITH have AS (SELECT DISTINCT p_brand AS brand FROM part WHERE p_size < 5), old AS (SELECT brand, row_number() OVER (ORDER BY brand) AS id FROM have),
fresh AS (SELECT DISTINCT p_brand AS brand FROM part WHERE p_brand NOT IN (SELECT brand FROM have))
SELECT id, brand, false AS created FROM old UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY brand), brand, true FROM fresh""")
def get_or_create(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), "p_size")
    old = S.new_ids(p.filter("p_size < 5").select("brand").distinct(), ["brand"])
    return S.get_or_create(p, old, "brand", "id")


@query("""SELECT c_custkey AS k, best.s_suppkey AS target FROM customer LEFT JOIN (SELECT n, d, s_suppkey FROM (SELECT s_name AS n, s_nationkey AS d, s_suppkey, row_number() OVER (PARTITION BY s_nationkey, s_name ORDER BY (s_acctbal > 0) DESC, s_suppkey DESC) AS r
FROM (SELECT 'S' || CAST(s_suppkey % 3 AS VARCHAR) AS s_name, s_nationkey, s_suppkey, s_acctbal FROM supplier)) WHERE r = 1) best ON best.n = 'S' || CAST(c_custkey % 4 AS VARCHAR) AND best.d = c_nationkey""")
def joint_lookup(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey as k", "concat('S', c_custkey % 4) as name", "c_nationkey as place")
    s = table(spark, sf, "supplier").selectExpr("concat('S', s_suppkey % 3) as n", "s_nationkey as d", "s_suppkey as target", "s_acctbal > 0 as active")
    return S.best_effort(c, ["name", "place"], s, ["n", "d"], "target", "active").select("k", "target")


@query("SELECT c_custkey AS k, e.event_type AS last_type FROM customer LEFT JOIN (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1) e ON e.user_id = c_custkey")
def latest_apply(spark, sf):
    last = S.latest_per(table(spark, sf, "events"), ["user_id"], F.col("event_type"), ["ts", "event_id"], "last_type")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).join(last.withColumnRenamed("user_id", "k"), "k", "left")


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphans(spark, sf):
    return S.orphans(table(spark, sf, "orders").select(F.col("o_orderkey").alias("k")), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


@query("SELECT p_partkey AS k FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40) AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_linestatus = 'O' AND l_quantity > 45)")
def unused_catalogue(spark, sf):
    li = table(spark, sf, "lineitem")
    return S.unused(table(spark, sf, "part").select(F.col("p_partkey").alias("k")), "k", (li.filter("l_returnflag = 'R' and l_quantity > 40"), "l_partkey"), (li.filter("l_linestatus = 'O' and l_quantity > 45"), "l_partkey"))


@query("""SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS rank, count(*) OVER (PARTITION BY user_id, event_type) AS group_size FROM events""")
def keep_latest(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.to_date("ts").alias("day"))
    return P.keep_latest(e, ["user_id", "event_type"], [F.col("day").desc_nulls_last(), F.col("event_id").desc()]).drop("day")


@query("SELECT l_orderkey AS k, min(l_returnflag) AS flag FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def unique_backfill(spark, sf):
    return P.unique_value(table(spark, sf, "lineitem").selectExpr("l_orderkey as k", "l_returnflag as flag"), ["k"], "flag")


@query("""WITH cur AS (SELECT o_orderkey AS k, o_orderkey % 3 <> 0 AS active, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS prio FROM orders), st AS (SELECT o_orderkey AS k, max(lower(o_orderpriority)) AS p FROM orders WHERE o_orderkey % 8 <> 0 GROUP BY 1)
SELECT cur.k, active, CASE WHEN active THEN coalesce(prio, p) ELSE prio END AS prio FROM cur LEFT JOIN st ON cur.k = st.k""")
def fill_from_staging(spark, sf):
    o = table(spark, sf, "orders")
    cur = o.selectExpr("o_orderkey as k", "o_orderkey % 3 <> 0 as active", "if(o_orderkey % 4 = 0, null, o_orderpriority) as prio")
    return P.fill_nulls(cur, o.filter("o_orderkey % 8 <> 0").selectExpr("o_orderkey as k", "lower(o_orderpriority) as prio"), ["k"], ["prio"])


@query("""WITH a AS (SELECT o_orderkey AS id, o_custkey % 50 AS domain, o_orderkey % 200 AS code, o_orderkey % 3 = 0 AS active FROM orders), pl AS (SELECT l_orderkey * 10 + l_linenumber AS plan_id, l_orderkey AS attribute_id FROM lineitem WHERE l_linenumber <> 2),
live AS (SELECT domain, code, count(*) AS n, min(id) AS live_id FROM a WHERE active GROUP BY 1, 2)
SELECT plan_id, attribute_id, CASE WHEN a.id IS NULL THEN 'UNKNOWN_ATTRIBUTE' WHEN a.active THEN 'CURRENT' WHEN n IS NULL THEN 'NO_LIVE_VERSION' WHEN n > 1 THEN 'SEVERAL_LIVE_VERSIONS' ELSE 'MOVED' END AS outcome,
CASE WHEN a.id IS NOT NULL AND NOT a.active AND n = 1 THEN live_id ELSE attribute_id END AS new_attribute_id FROM pl LEFT JOIN a ON attribute_id = a.id LEFT JOIN live ON a.domain = live.domain AND a.code = live.code""")
def relink_unique(spark, sf):
    a = table(spark, sf, "orders").selectExpr("o_orderkey as id", "o_custkey % 50 as domain", "o_orderkey % 200 as code", "o_orderkey % 3 = 0 as active")
    plans = table(spark, sf, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as plan_id", "l_orderkey as attribute_id", "l_linenumber <> 2 as active")
    return P.relink(plans, a)


@query("""SELECT o_orderkey AS k, o_orderkey % 5 <> 0 AND o_totalprice >= 100000 AS active, CASE WHEN o_orderkey % 5 <> 0 AND o_totalprice < 100000 THEN DATE '1999-01-01' END AS end_date, o_orderkey % 5 <> 0 AND o_totalprice < 100000 AS retired FROM orders""")
def retire_by_predicate(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderkey % 5 <> 0 as active", "cast(null as date) as end_date", "o_totalprice")
    return P.retire(o, F.col("o_totalprice") < 100000, F.to_date(F.lit("1999-01-01"))).drop("o_totalprice")


@query("""SELECT s_nationkey AS domain, s_suppkey % 4 AS dest, s_suppkey AS k FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey % 4, s_nationkey ORDER BY s_acctbal DESC, s_suppkey DESC) AS n FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_custkey % 40 = 0)) WHERE n = 1""")
def seed_new_domains(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("s_nationkey as domain", "s_suppkey % 4 as dest", "s_suppkey as k", "s_acctbal")
    present = table(spark, sf, "customer").filter("c_custkey % 40 = 0").select(F.col("c_nationkey").alias("domain"))
    return P.seed(s, present, "domain", ["dest", "domain"], [F.col("s_acctbal").desc(), F.col("k").desc()]).drop("s_acctbal")


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority WHEN o_orderkey % 2 = 0 THEN 'LATER' ELSE o_orderpriority END AS prio, o_orderkey % 4 = 0 AS restored FROM orders""")
def guarded_rollback(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderpriority as prio")
    cur = o.selectExpr("k", "case when k % 4 = 0 then 'NEW' when k % 2 = 0 then 'LATER' else prio end as prio")
    return P.guarded_rollback(cur, o, "k", "prio", o.filter("k % 2 = 0").selectExpr("k", "'NEW' as prio"))


@query("""SELECT CAST(count(*) FILTER (o_orderkey % 4 = 0) AS BIGINT) AS n_changed, CAST(count(*) FILTER (o_orderkey % 3 = 0) AS BIGINT) AS n_active_before, CAST(count(*) FILTER (o_orderkey % 3 = 0) AS BIGINT) AS n_active_after, CAST(count(*) FILTER (o_orderkey % 4 = 0) AS BIGINT) AS n_expected, true AS ok FROM orders""")
def verified_repair(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderpriority as prio", "o_orderkey % 3 = 0 as active")
    return P.verified(o, o.withColumn("prio", F.expr("if(k % 4 = 0, 'NEW', prio)")), "k", "prio", o.filter("k % 4 = 0"))


@query("""SELECT n_nationkey + CASE WHEN n_nationkey % 3 = 0 THEN 100 ELSE 0 END AS id, n_name || CASE WHEN n_nationkey % 5 = 1 THEN '!' ELSE '' END AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'INSERT' WHEN n_nationkey % 5 = 1 THEN 'CONFLICT' ELSE 'PRESENT' END AS outcome FROM nation""")
def catalogue_upsert(spark, sf):
    n = table(spark, sf, "nation")
    wanted = n.selectExpr("n_nationkey + if(n_nationkey % 3 = 0, 100, 0) as id", "concat(n_name, if(n_nationkey % 5 = 1, '!', '')) as name")
    return P.catalogue_upsert(n.selectExpr("n_nationkey as id", "n_name as name"), wanted, "id", "name")


@query("""SELECT c_nationkey AS g, count(*) AS n FROM customer WHERE c_custkey % 3 <> 0 AND c_name NOT IN (SELECT c_name FROM customer WHERE c_custkey % 4 = 0) GROUP BY 1""")
def missing_in_staging(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey as k", "c_name as name", "c_nationkey as g", "c_custkey % 3 <> 0 as active")
    return P.missing_in_staging(c, c.filter("k % 4 = 0"), ["name"], "g")


@query("""SELECT * FROM (SELECT 'text' AS "column", 500 AS width, max(length(text)) AS longest, count(*) FILTER (length(text) > 500) AS n_over, min(doc_id) FILTER (length(text) > 500) AS first_row, arg_min(substr(text, 1, 60), doc_id) FILTER (length(text) > 500) AS preview FROM documents
UNION ALL SELECT 'source', 4, max(length(source)), count(*) FILTER (length(source) > 4), min(doc_id) FILTER (length(source) > 4), arg_min(substr(source, 1, 60), doc_id) FILTER (length(source) > 4) FROM documents)""")
def width_audit(spark, sf):
    return V.width_audit(table(spark, sf, "documents"), {"text": 500, "source": 4}, "doc_id")


@query("""SELECT g, row_no, missing, greatest(n_bad - 20, 0) AS n_more FROM (SELECT g, row_no, missing, row_number() OVER (PARTITION BY g ORDER BY row_no) AS r, count(*) OVER (PARTITION BY g) AS n_bad FROM (
SELECT c_nationkey AS g, c_custkey AS row_no, concat_ws(',', CASE WHEN c_custkey % 6 = 0 THEN 'a' END, CASE WHEN c_custkey % 10 = 0 THEN 'b' END) AS missing FROM customer WHERE c_custkey % 6 = 0 OR c_custkey % 10 = 0)) WHERE r <= 20""")
def required_check(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_nationkey as g", "c_custkey as row_no", "if(c_custkey % 6 = 0, ' - ', c_name) as a", "if(c_custkey % 10 = 0, '', c_mktsegment) as b")
    return V.required_values(c, ["a", "b"], ["g"], "row_no")


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_orderdate AS DATE) END AS d, CASE WHEN o_orderkey % 5 = 4 THEN 'no date: ' || strftime(o_orderdate, '%Y.%m.%d') END AS error FROM orders""")
def date_formats(spark, sf):
    forms = "case o_orderkey % 5 when 0 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') when 1 then date_format(o_orderdate, 'd-M-yyyy') when 2 then date_format(o_orderdate, 'dd/MM/yyyy') when 3 then concat(' ', date_format(o_orderdate, 'd/M/yyyy')) else date_format(o_orderdate, 'yyyy.MM.dd') end as t"
    value, error = C.any_date(F.col("t"))
    return table(spark, sf, "orders").selectExpr("o_orderkey as k", forms).select("k", value.alias("d"), error.alias("error"))


@query("""WITH t AS (SELECT o_orderkey AS k, o_orderkey % 8 AS m FROM orders) SELECT k, CASE m WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN false END AS flag, CASE m WHEN 0 THEN true WHEN 1 THEN false WHEN 4 THEN true WHEN 5 THEN false END AS yes,
CASE m WHEN 4 THEN 70 WHEN 5 THEN -3 WHEN 6 THEN 12 END AS number, CASE WHEN m = 7 THEN 'no whole number: 1x' END AS number_error, CASE WHEN m = 6 THEN 'ADS-B' END AS domain, CASE WHEN m = 6 THEN 4 END AS code, CASE WHEN m = 7 THEN '6.1' END AS level FROM t""")
def clean_rules(spark, sf):
    t = table(spark, sf, "orders").selectExpr(
        "o_orderkey as k", "element_at(array('X', '-', '', null, 'x', 'Y', 'XX', 'no'), cast(o_orderkey % 8 as int) + 1) as flag", "element_at(array('Sí', 'no', '', null, 'SI', 'No', 'maybe', '-'), cast(o_orderkey % 8 as int) + 1) as yes",
        "element_at(array('', '-', null, 'nan', '70.0', '-3.9', ' 12 ', '1x'), cast(o_orderkey % 8 as int) + 1) as number", "if(o_orderkey % 8 = 6, 'ADS-B-4', null) as code", "if(o_orderkey % 8 = 7, '6.1. Text', null) as level",
    )
    n, e = C.tolerant_int(F.col("number"))
    d, c, _ = C.code_parts(F.col("code"))
    return t.select("k", C.x_flag(F.col("flag"))[0].alias("flag"), C.yes_no(F.col("yes"))[0].alias("yes"), n.alias("number"), e.alias("number_error"), d.alias("domain"), c.alias("code"), C.leading_code(F.col("level"), 2)[0].alias("level"))


@query("""SELECT doc_id AS k, regexp_replace(trim(lower(strip_accents(text)), ' \t\r' || chr(10) || chr(11) || chr(12)), '\\s+', ' ', 'g') AS folded, CASE WHEN upper(strip_accents(substr(text, 1, 1))) BETWEEN 'A' AND 'Z' THEN upper(strip_accents(substr(text, 1, 1))) ELSE '#' END AS letter,
CASE WHEN length(text) > 40 THEN substr(text, 1, 40) || '…' ELSE text END AS short FROM documents""")
def folded_texts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("k"), C.fold_spaces(F.col("text")).alias("folded"), C.initial(F.substring("text", 1, 1)).alias("letter"), C.cut(F.col("text"), 40).alias("short"))


@query("""WITH sheets AS (SELECT o_custkey AS file, o_orderkey AS k FROM orders), anchor AS (SELECT c_custkey AS file, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS key FROM customer UNION ALL SELECT c_custkey, 'EXTRA' FROM customer WHERE c_custkey % 5 = 0),
a AS (SELECT file, count(DISTINCT key) AS n, min(key) AS key FROM anchor GROUP BY 1) SELECT sheets.file, k, CASE WHEN n = 1 THEN a.key END AS domain, CASE WHEN n = 0 THEN 'no key in the anchor sheet' WHEN n > 1 THEN 'several keys in the anchor sheet' END AS key_error FROM sheets LEFT JOIN a USING (file)""")
def inherited_key(spark, sf):
    c = table(spark, sf, "customer")
    anchor = c.selectExpr("c_custkey as file", "if(c_custkey % 4 = 0, ' - ', concat('N', c_nationkey)) as domain").unionByName(c.filter("c_custkey % 5 = 0").selectExpr("c_custkey as file", "'EXTRA' as domain"))
    return V.inherited_key(table(spark, sf, "orders").selectExpr("o_custkey as file", "o_orderkey as k", "cast(null as string) as domain"), anchor, "file", "domain")


@query("""SELECT supp, bin, max(d) AS d FROM (SELECT l_suppkey AS supp, l_orderkey % 400 AS bin, CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY 1, 2 HAVING count(DISTINCT d) = 1""")
def consistent_rows(spark, sf):
    return V.consistent_rows(table(spark, sf, "lineitem").selectExpr("l_suppkey as supp", "l_orderkey % 400 as bin", "to_date(l_shipdate) as d"), ["supp", "bin"], "d")[0]


def headers(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_orderkey as file", "concat('sheet', l_linenumber % 2) as sheet", "l_linenumber as pos", "concat(l_returnflag, l_linestatus) as name")
    return li.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").drop("l_orderkey")


@query("""WITH h AS (SELECT l_orderkey AS file, 'sheet' || CAST(l_linenumber % 2 AS VARCHAR) AS sheet, l_linenumber AS pos, l_returnflag || l_linestatus AS name FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
l AS (SELECT file, sheet, string_agg(name, '|' ORDER BY pos, name) AS cols FROM h GROUP BY 1, 2) SELECT file, sha256(string_agg(sheet || chr(9) || cols, chr(10) ORDER BY sheet)) AS fingerprint FROM l GROUP BY 1""")
def fingerprint(spark, sf):
    return G.fingerprints(headers(spark, sf))


#: state, fingerprint, fingerprint of the registered columns, smallest loader, end of grace, by version
VERSIONS = {
    "1.0.0": ("RETIRED", "f0", "f0", "1.0.0", None), "1.1.0": ("DEPRECATED", "f1", "f1", "1.0.0", "1998-06-01"), "1.2.0": ("DEPRECATED", "f2", "f2", "1.0.0", "1990-01-01"), "2.0.0": ("LIVE", "f3", "f3", "1.0.0", None),
    "2.1.0": ("LIVE", "f4", "fx", "1.0.0", None), "2.2.0": ("LIVE", "f5", "f5", "1.10.0", None), "3.0.0": ("DRAFT", "f6", "f6", "1.0.0", None),
}
REGISTRY = ", ".join(f"('t', '{v}', '{s}', '{f}', '{c}', '{m}', {f"DATE '{g}'" if g else 'CAST(NULL AS DATE)'})" for v, (s, f, c, m, g) in VERSIONS.items())
REGISTRY = f"(VALUES {REGISTRY}) AS v(template, version, state, fingerprint, columns_fingerprint, min_loader, grace_end)"
ASKED = ["9.9.9", *VERSIONS]


@query(f"""WITH r AS (SELECT * FROM {REGISTRY}), f AS (SELECT o_orderkey AS file, 't' AS template, list_extract({ASKED}, CAST(o_orderkey % 8 AS INTEGER) + 1) AS version, CASE WHEN o_orderkey % 3 = 0 THEN 'other' ELSE 'f' || CAST(o_orderkey % 8 - 1 AS VARCHAR) END AS fp FROM orders),
x AS (SELECT file, f.template, f.version, CASE WHEN r.state IS NULL THEN 'unknown version' WHEN state = 'DRAFT' THEN 'draft' WHEN state = 'RETIRED' THEN 'retired' WHEN state = 'DEPRECATED' AND (grace_end IS NULL OR DATE '1998-01-01' > grace_end) THEN 'deprecated past its grace'
 WHEN min_loader = '1.10.0' THEN 'loader too old' WHEN fingerprint IS DISTINCT FROM columns_fingerprint THEN 'registry inconsistent' WHEN fp IS DISTINCT FROM fingerprint THEN 'structure differs' WHEN state = 'DEPRECATED' THEN 'deprecated, in its grace' ELSE 'accepted' END AS reason
 FROM f LEFT JOIN r ON f.template = r.template AND f.version = r.version)
SELECT *, CASE WHEN reason = 'loader too old' THEN 'REJECTED_LOADER' WHEN reason = 'structure differs' THEN 'REJECTED_STRUCTURE' WHEN reason IN ('accepted', 'deprecated, in its grace') THEN 'ACCEPTED' ELSE 'REJECTED_VERSION' END AS decision FROM x""")
def version_decision(spark, sf):
    version = F.element_at(F.array(*map(F.lit, ASKED)), (F.col("o_orderkey") % 8).cast("int") + 1)
    files = table(spark, sf, "orders").select(F.col("o_orderkey").alias("file"), F.lit("t").alias("template"), version.alias("version"), F.expr("if(o_orderkey % 3 = 0, 'other', concat('f', o_orderkey % 8 - 1))").alias("fingerprint"))
    return G.version_decisions(files, spark.sql(f"SELECT * FROM {REGISTRY}"), "1.9.5", F.to_date(F.lit("1998-01-01")))


LOADS = """loads AS (SELECT event_id AS id_load, CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id END AS domain, md5(CAST(event_id % 50 AS VARCHAR)) AS hash, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'MERGE_OK' WHEN 'view' THEN 'SKIPPED_UNCHANGED' ELSE 'MERGE_PARTIAL' END AS state,
CAST(ts AS DATE) AS started, CASE WHEN event_id % 3 <> 0 THEN 'p' END AS archived_path, CASE WHEN event_id % 7 = 0 THEN ts END AS purged FROM events)"""


def loads(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id as id_load", "if(user_id % 9 = 0, null, user_id) as domain", "md5(cast(event_id % 50 as string)) as hash",
        "case event_type when 'error' then 'ERROR' when 'click' then 'MERGE_OK' when 'view' then 'SKIPPED_UNCHANGED' else 'MERGE_PARTIAL' end as state", "to_date(ts) as started", "if(event_id % 3 <> 0, 'p', null) as archived_path", "if(event_id % 7 = 0, ts, null) as purged",
    )


@query(f"""WITH {LOADS}, good AS (SELECT domain, max(id_load) AS last_id, arg_max(hash, id_load) AS last_hash FROM loads WHERE state IN ('MERGE_OK', 'SKIPPED_UNCHANGED') GROUP BY 1),
f AS (SELECT c_custkey AS file, c_custkey % 150 AS domain, md5(CAST(c_custkey % 50 AS VARCHAR)) AS hash, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 100 END AS base_id FROM customer)
SELECT file, f.domain, CASE WHEN base_id IS NOT NULL AND base_id IS DISTINCT FROM last_id THEN 'REJECTED_STALE' WHEN f.hash = last_hash THEN 'SKIPPED_UNCHANGED' ELSE 'ACCEPTED' END AS gate, base_id IS NULL AND last_id IS NOT NULL AS base_warning FROM f LEFT JOIN good ON f.domain = good.domain""")
def stale_base(spark, sf):
    files = table(spark, sf, "customer").selectExpr("c_custkey as file", "c_custkey % 150 as domain", "md5(cast(c_custkey % 50 as string)) as hash", "if(c_custkey % 2 = 0, c_custkey % 100, null) as base_id")
    return G.base_gate(files, loads(spark, sf))


@query(f"""WITH {LOADS}, newest AS (SELECT domain, max(id_load) AS id_load FROM loads WHERE state IN ('MERGE_OK', 'SKIPPED_UNCHANGED') GROUP BY 1)
SELECT id_load, domain, state FROM loads WHERE archived_path IS NOT NULL AND purged IS NULL AND started < DATE '2024-01-20' - 10 AND id_load NOT IN (SELECT id_load FROM newest)""")
def retention(spark, sf):
    return G.retention(loads(spark, sf), F.to_date(F.lit("2024-01-20")), 10).select("id_load", "domain", "state")


@query("""WITH s AS (SELECT l_orderkey AS id_load, CASE WHEN l_linenumber = 1 THEN 'gate' WHEN l_linenumber % 2 = 0 THEN 'sheet' ELSE 'merge' END AS step, CASE WHEN l_linenumber = 1 AND l_suppkey % 10 = 0 THEN 'REJECTED_STALE' ELSE 'ACCEPTED' END AS outcome, CASE WHEN l_quantity > 45 THEN 'e' END AS error FROM lineitem),
g AS (SELECT id_load, min(CASE WHEN step = 'gate' AND outcome <> 'ACCEPTED' THEN outcome END) AS gate, count(*) FILTER (step = 'sheet' AND error IS NOT NULL) AS bad_sheets, count(*) FILTER (step = 'merge' AND error IS NOT NULL) AS bad_merges FROM s GROUP BY 1)
SELECT id_load, coalesce(gate, CASE WHEN bad_sheets > 0 THEN 'ERROR_STAGING' WHEN bad_merges >= 2 THEN 'ERROR_MERGE' WHEN bad_merges > 0 THEN 'MERGE_PARTIAL' ELSE 'MERGE_OK' END) AS state, bad_sheets, bad_merges FROM g""")
def status_fold(spark, sf):
    s = table(spark, sf, "lineitem").selectExpr("l_orderkey as id_load", "case when l_linenumber = 1 then 'gate' when l_linenumber % 2 = 0 then 'sheet' else 'merge' end as step", "if(l_linenumber = 1 and l_suppkey % 10 = 0, 'REJECTED_STALE', 'ACCEPTED') as outcome", "if(l_quantity > 45, 'e', null) as error")
    return G.load_status(s, objects=2)


@query("""SELECT user_id AS id_load, arg_max(event_type, event_id) FILTER (event_type <> 'error') AS state, arg_max(value, event_id) FILTER (event_id % 3 = 0) AS rows FROM events GROUP BY 1""")
def load_history(spark, sf):
    e = table(spark, sf, "events").selectExpr("user_id as id_load", "event_id as seq", "if(event_type <> 'error', event_type, null) as state", "if(event_id % 3 = 0, value, null) as rows")
    return G.current_loads(e, ["state", "rows"])


@query("""WITH cur AS (SELECT c_custkey AS k, c_nationkey AS domain, c_acctbal AS v FROM customer WHERE c_custkey % 2 = 0), batch AS (SELECT c_custkey AS k, c_nationkey AS domain, c_acctbal + 1 AS v FROM customer WHERE c_nationkey IN (1, 2) AND c_custkey % 3 = 0)
SELECT * FROM cur WHERE domain NOT IN (1, 2, 3) UNION ALL SELECT * FROM batch""")
def slice_replace(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey as k", "c_nationkey as domain", "c_acctbal as v")
    touched = table(spark, sf, "nation").filter("n_nationkey in (1, 2, 3)").select(F.col("n_nationkey").alias("domain"))
    return sheets.replace_slices(c.filter("k % 2 = 0"), c.filter("domain in (1, 2) and k % 3 = 0").withColumn("v", F.col("v") + 1), touched)


@query("SELECT o_orderkey AS k, o_orderpriority || '-' || CAST(o_orderkey % 7 AS VARCHAR) AS code FROM orders WHERE starts_with(o_orderpriority || '-' || CAST(o_orderkey % 7 AS VARCHAR), '2-HIGH-')")
def prefix_slice(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.expr("concat(o_orderpriority, '-', o_orderkey % 7)").alias("code"))
    return o.filter(sheets.in_slice("code", F.lit("2-HIGH"), by_prefix=True))


@query("""WITH kv AS (SELECT o_orderkey AS file, 'template' AS k, o_orderpriority AS v FROM orders UNION ALL SELECT o_orderkey, 'base_load', CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END FROM orders)
SELECT file, max(v) FILTER (k = 'template') AS template, CAST(NULL AS VARCHAR) AS version, CAST(NULL AS VARCHAR) AS domain, TRY_CAST(max(v) FILTER (k = 'base_load') AS BIGINT) AS base_load, CAST(NULL AS VARCHAR) AS created FROM kv GROUP BY 1""")
def control_block(spark, sf):
    o = table(spark, sf, "orders")
    kv = o.selectExpr("o_orderkey as file", "' template ' as key", "o_orderpriority as value").unionByName(o.selectExpr("o_orderkey as file", "'base_load' as key", "if(o_orderkey % 3 = 0, 'x', cast(o_custkey as string)) as value")).unionByName(o.selectExpr("o_orderkey as file", "' ' as key", "'y' as value"))
    return sheets.control_blocks(kv)


@query("""WITH st AS (SELECT DISTINCT l_suppkey AS domain, CASE WHEN l_suppkey % 3 = 0 THEN l_linenumber ELSE 1 END AS id_load FROM lineitem)
SELECT s_suppkey AS domain, CAST(1 AS BIGINT) AS last_id, CASE WHEN count(id_load) > 0 THEN coalesce(string_agg(CAST(id_load AS VARCHAR), ',' ORDER BY id_load) FILTER (id_load <> 1), '') END AS other_ids, count(id_load) > 0 AND count(*) FILTER (id_load <> 1) = 0 AS ok FROM supplier LEFT JOIN st ON s_suppkey = st.domain GROUP BY 1""")
def rebuildable(spark, sf):
    staged = table(spark, sf, "lineitem").selectExpr("l_suppkey as domain", "cast(if(l_suppkey % 3 = 0, l_linenumber, 1) as bigint) as id_load")
    return sheets.rebuildable(staged, table(spark, sf, "supplier").selectExpr("s_suppkey as domain", "cast(1 as bigint) as last_id"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'A' || o_orderstatus WHEN o_orderkey % 2 = 0 THEN 'S' || o_orderstatus END AS v, CASE WHEN o_orderkey % 3 = 0 THEN 'archive' WHEN o_orderkey % 2 = 0 THEN 'staging' END AS source FROM orders""")
def source_fallback(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_orderstatus as v")
    return sheets.with_fallback(o.select("k"), o.filter("k % 3 = 0").withColumn("v", F.concat(F.lit("A"), "v")), o.filter("k % 2 = 0").withColumn("v", F.concat(F.lit("S"), "v")), ["k"], "v")
