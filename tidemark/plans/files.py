"""Queries of files and sinks: what arrives, what headers say, what is published and kept."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import gates as G
from ..operators import repair as P
from ..sources import sheets
from ..sources.versions import Part, Store
from .registry import query, table


@query("SELECT octet_length(encode(t)) AS length, sha256(t) AS hash FROM (SELECT string_agg(c_name || chr(10), '' ORDER BY c_name) AS t FROM customer GROUP BY c_nationkey)")
def file_hashes(spark, sf):
    """Each nation's customers as a file; a lock file and an empty one beside them don't count."""
    root = sheets.shared_folder(spark)
    rows = table(spark, sf, "customer").selectExpr("c_nationkey as nation", "c_name as value")
    rows.repartition("nation").sortWithinPartitions("nation", "value").write.partitionBy("nation").text(f"{root}/files")
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, text in (("~$open.txt", b"lock"), ("none.txt", b"")):
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/files/nation=0/{name}"))
        out.write(bytearray(text))
        out.close()
    return sheets.settled_files(spark, f"{root}/files/*", "*.txt").select("length", "hash")


@query("""WITH h AS (SELECT l_orderkey AS file, l_partkey AS pos, CASE WHEN l_linenumber % 3 = 0 THEN ' ' WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_returnflag END AS name FROM lineitem)
SELECT file, pos, name FROM (SELECT *, max(CASE WHEN trim(coalesce(name, '')) <> '' THEN pos END) OVER (PARTITION BY file) AS last FROM h) WHERE pos <= last""")
def header_scan(spark, sf):
    """Header rows without the blank cells behind the last name."""
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey as file", "'s' as sheet", "l_partkey as pos", "case when l_linenumber % 3 = 0 then ' ' when l_linenumber % 5 = 0 then null else l_returnflag end as name")
    return G.trimmed_headers(li).select("file", "pos", "name")


@query("SELECT p_partkey AS k, 'Código ' || regexp_replace(trim(p_name), '\\s+', ' ', 'g') || ' año' AS name FROM part")
def header_names(spark, sf):
    """Names in composed letters with single blanks, typed with accents of their own and blanks at will."""
    typed = F.concat(F.lit("  Código   "), F.regexp_replace("p_name", " ", "   "), F.lit(" año\t"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), C.header_name(typed).alias("name"))


@query("SELECT o_orderkey AS k, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'F'")
def published_snapshot(spark, sf):
    """A table that is replaced as a whole, twice."""
    root = sheets.shared_folder(spark)
    orders = table(spark, sf, "orders").selectExpr("o_orderkey as k", "o_totalprice as price", "o_orderstatus as status")
    sheets.publish_snapshot(orders.drop("status"), root)
    sheets.publish_snapshot(orders.filter("status <> 'F'").drop("status"), root)
    return sheets.current_snapshot(spark, root)


@query("""SELECT 'orders' AS name, c_nationkey AS domain, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey NOT IN (3, 4) GROUP BY 2
UNION ALL SELECT 'orders', c_nationkey, count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 3 AND o_orderstatus = 'F' GROUP BY 2 UNION ALL SELECT 'log', c_nationkey, 2 FROM customer WHERE c_nationkey IN (3, 4) GROUP BY 2""")
def slices_published(spark, sf):
    """Two tables in one version: two domains' slices are replaced, one of them by nothing, and a log grows by what was done."""
    store = Store(spark, sheets.shared_folder(spark))
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.expr("c_custkey = o_custkey")).selectExpr("c_nationkey as domain", "o_orderkey as k", "o_orderstatus as status")
    every = tuple(sorted(str(r["n_nationkey"]) for r in table(spark, sf, "nation").select("n_nationkey").collect()))
    touched = table(spark, sf, "nation").filter("n_nationkey in (3, 4)").selectExpr("n_nationkey as domain")
    first = store.publish([Part("orders", o, "domain", every), Part("log", touched, append=True)], store.latest())
    store.publish([Part("orders", o.filter("domain = 3 and status = 'F'"), "domain", ("3", "4")), Part("log", touched, append=True)], first)
    counted = lambda t: store.read(t).groupBy("domain").agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "domain", "n")
    return counted("orders").unionByName(counted("log"))


@query("SELECT s_suppkey AS k, s_name AS name, true AS first_copy, false AS second_copy FROM supplier")
def backup_copy(spark, sf):
    """A copy is made once; a second one is refused and leaves the first as it is."""
    path = f"{sheets.shared_folder(spark)}/backup"
    s = table(spark, sf, "supplier").selectExpr("s_suppkey as k", "s_name as name")
    made = P.backup_once(s, path), P.backup_once(s.limit(0), path)
    return spark.read.parquet(path).select("k", "name", F.lit(made[0]).alias("first_copy"), F.lit(made[1]).alias("second_copy"))
