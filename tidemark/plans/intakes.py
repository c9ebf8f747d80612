"""Queries of submissions and linked plans. Stand-ins: domain = event type, attribute = user, its total = the sum of the user's events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import gates as G
from ..operators import reconcile as R
from ..sources.sheets import Contract, kept, shared_folder
from ..sources.versions import Store
from ..streaming.submissions import ACTIONS, LOADS, Submissions
from . import merging
from .registry import query, table

SHEET = Contract("attributes", ("domain", "code", "total", "approval_date"), key="domain", dates={"approval_date": "yyyy-MM-dd"})
TEMPLATE, VERSION, LOADER = "catalogue", "1.2.0", "2.0.0"


def typed(rows: DataFrame) -> DataFrame:
    code, code_error = C.tolerant_int(F.col("code"))
    date = F.col("approval_date").try_cast("date")
    total = F.col("total").try_cast("bigint")
    errors = [code_error, F.when(code.isNull(), "missing: code"), F.when(F.col("approval_date").isNotNull() & date.isNull(), F.concat(F.lit("no date: "), F.col("approval_date")))]
    return rows.select("id_load", "place", "domain", code.alias("code"), total.alias("total"), date.alias("approval_date"), F.array_join(F.array_compact(F.array(*errors)), "; ").alias("errors"))


def submissions(spark, root: str) -> Submissions:
    headers = spark.createDataFrame([("f", SHEET.name, k, c) for k, c in enumerate(SHEET.columns)], "file string, sheet string, pos int, name string")
    printed = G.fingerprints(headers).select("fingerprint")
    known = "template string, version string, state string, min_loader string, grace_end date"
    registry = spark.createDataFrame([(TEMPLATE, VERSION, "LIVE", "1.0.0", None), (TEMPLATE, "1.1.0", "RETIRED", "1.0.0", None)], known).join(printed).withColumn("columns_fingerprint", F.col("fingerprint"))
    registry = spark.createDataFrame(registry.toArrow())  # two rows, which each batch asks
    return Submissions(Store(spark, f"{root}/store"), SHEET, registry, TEMPLATE, LOADER, F.to_date(F.lit("2024-06-01")), typed, ["domain", "code"], ["total"])


def control(template: str = TEMPLATE, version: str = VERSION, domain=None, base=None):
    fields = {"template": F.lit(template), "version": F.lit(version), "domain": domain if domain is not None else F.lit(None).cast("string"), "base_load": base if base is not None else F.lit(None).cast("string")}
    return F.to_json(F.struct(F.struct(*(v.alias(k) for k, v in fields.items())).alias("control")))


def totals(spark, sf) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("domain"), F.col("user_id").alias("code")).agg((100 * F.sum(F.col("value").cast("decimal(18,2)"))).cast("bigint").alias("total"))


def lines(rows: DataFrame) -> DataFrame:
    """file, value: a sheet's rows as JSON."""
    told = [F.col(c).cast("string").alias(c) for c in SHEET.columns]
    return rows.select("file", F.to_json(F.struct(F.struct(*told).alias("row"))).alias("value"))


def arrive(files: DataFrame, folder: str) -> None:
    """Each file's lines as one file, control first."""
    files.repartition("file").sortWithinPartitions("file", "value").write.mode("append").partitionBy("file").text(folder)


DAY = "date_add(date'2024-01-01', cast(code % 3 as int))"


@query("""WITH t AS (SELECT event_type AS domain, user_id AS code, CAST(100 * sum(CAST(value AS DECIMAL(18, 2))) AS BIGINT) AS total FROM events GROUP BY 1, 2),
o AS (SELECT *, DATE '2024-01-01' + CAST(code % 3 AS INTEGER) AS d FROM t WHERE code % 5 <> 0), n AS (SELECT domain, code, total + CASE WHEN code % 2 = 0 THEN 1 ELSE 0 END AS total, DATE '2024-01-02' + CAST(code % 2 AS INTEGER) AS d FROM t WHERE code % 7 <> 0),
p AS (SELECT domain, CASE WHEN o.code IS NULL THEN 'INSERT' WHEN n.code IS NULL THEN 'DELETE' WHEN o.d = n.d AND o.total = n.total THEN 'UNCHANGED' WHEN o.d = n.d THEN 'UPDATE' WHEN n.d > o.d THEN 'REPLACE' ELSE 'SKIP' END AS a FROM o FULL JOIN n USING (domain, code)),
m AS (SELECT domain, count(*) FILTER (a = 'INSERT') AS "insert", count(*) FILTER (a = 'UPDATE') AS "update", count(*) FILTER (a = 'REPLACE') AS "replace", count(*) FILTER (a = 'DELETE') AS "delete", count(*) FILTER (a = 'SKIP') AS skip_date_regressed FROM p GROUP BY 1),
f1 AS (SELECT '1-' || domain AS file, domain, CASE domain WHEN 'view' THEN 'REJECTED_VERSION' WHEN 'error' THEN 'REJECTED_CONTROL' ELSE 'MERGE_OK' END AS state, count(*) AS n_rows, 0 AS n_errors FROM o GROUP BY domain),
f2 AS (SELECT '2-' || domain AS file, domain, CASE domain WHEN 'signup' THEN 'REJECTED_STALE' WHEN 'purchase' THEN 'ERROR_STAGING' WHEN 'error' THEN 'REJECTED_DOMAIN' ELSE 'MERGE_OK' END AS state, count(*) AS n_rows, CASE domain WHEN 'purchase' THEN count(*) FILTER (code % 10 = 3) ELSE 0 END AS n_errors FROM n GROUP BY domain),
f3 AS (SELECT '3-' || domain AS file, domain, 'SKIPPED_UNCHANGED' AS state, n_rows, 0 AS n_errors FROM f1 WHERE domain = 'signup')
SELECT file, domain, state, n_rows, n_errors, CAST(CASE WHEN state <> 'MERGE_OK' THEN 0 WHEN file[1] = '1' OR domain = 'view' THEN n_rows ELSE "insert" END AS BIGINT) AS "insert",
       CASE WHEN state = 'MERGE_OK' AND file = '2-click' THEN "update" ELSE 0 END AS "update", CASE WHEN state = 'MERGE_OK' AND file = '2-click' THEN "replace" ELSE 0 END AS "replace",
       CASE WHEN state = 'MERGE_OK' AND file = '2-click' THEN "delete" ELSE 0 END AS "delete", CASE WHEN state = 'MERGE_OK' AND file = '2-click' THEN skip_date_regressed ELSE 0 END AS skip_date_regressed
FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3) f JOIN m USING (domain)""")
def submission_intake(spark, sf):
    """All events as submissions in two rounds, and a file that comes again: first loads (one of an unknown version, one without control),
    then changes (one on a stale base, one with rows in error, one whose control names another domain). One outcome a file."""
    root = shared_folder(spark)
    job, folder = submissions(spark, root), f"{root}/arriving"
    all_ = kept(totals(spark, sf))
    domains = all_.select("domain").distinct()

    def run() -> DataFrame:
        job.start(spark, folder, f"{root}/checkpoint", files_per_batch=4).awaitTermination()
        return job.store.read(LOADS)

    first = all_.filter("code % 5 <> 0").withColumn("approval_date", F.expr(DAY)).withColumn("file", F.concat(F.lit("1-"), "domain"))
    heads = domains.filter("domain <> 'error'").select(F.concat(F.lit("1-"), "domain").alias("file"), F.when(F.col("domain") == "view", control(version="0.9")).otherwise(control(domain=F.col("domain"))).alias("value"))
    arrive(lines(first).union(heads), folder)
    loads = run()
    base = domains.join(G.last_good(loads), "domain", "left").select("domain", F.when(F.col("domain") == "signup", F.col("last_id") + 1000).otherwise(F.col("last_id")).cast("string").alias("base"))
    day = F.when((F.col("domain") == "purchase") & (F.col("code") % 10 == 3), "31/31/2024").otherwise(F.expr("cast(date_add(date'2024-01-02', cast(code % 2 as int)) as string)"))
    second = all_.filter("code % 7 <> 0").withColumns({"total": F.expr("total + if(code % 2 = 0, 1, 0)"), "approval_date": day, "file": F.concat(F.lit("2-"), "domain")})
    heads = base.select(F.concat(F.lit("2-"), "domain").alias("file"), control(domain=F.when(F.col("domain") == "error", "other").otherwise(F.col("domain")), base=F.col("base")).alias("value"))
    arrive(lines(second).union(heads), folder)
    run()
    # the same content as the last good load of its domain
    again = first.filter("domain = 'signup'").withColumn("file", F.lit("3-signup"))
    arrive(lines(again).union(domains.filter("domain = 'signup'").select(F.lit("3-signup").alias("file"), control(domain=F.col("domain")).alias("value"))), folder)
    return run().select(F.regexp_extract("file", "file=([^/]*)/", 1).alias("file"), "domain", "state", "n_rows", "n_errors", *ACTIONS)


@query("""WITH t AS (SELECT event_type AS domain, user_id AS code FROM events GROUP BY 1, 2) SELECT 'all-' || domain AS file, domain, 'MERGE_OK' AS state, count(*) AS n_rows, count(*) AS n_inserts, 0 AS n_versions FROM t GROUP BY domain""")
def dry_submissions(spark, sf):
    """First loads of all domains without a sink: outcomes are those of a run, and there is no version afterwards."""
    root = shared_folder(spark)
    job, folder = submissions(spark, root), f"{root}/arriving"
    job.dry = True
    rows = kept(totals(spark, sf)).withColumn("approval_date", F.expr(DAY)).withColumn("file", F.concat(F.lit("all-"), "domain"))
    heads = rows.select("file", "domain").distinct().select("file", control(domain=F.col("domain")).alias("value"))
    arrive(lines(rows).union(heads), folder)
    job.start(spark, folder, f"{root}/checkpoint").awaitTermination()
    told = [(f["file"].split("file=")[1].split("/")[0], f["domain"], f["state"], f["n_rows"], f["insert"], len(job.store.numbers())) for f in job.outcomes]
    return spark.createDataFrame(told, "file string, domain string, state string, n_rows long, n_inserts long, n_versions int")


LINKED = """p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 10 + 1 ELSE o_orderkey * 10 END AS id FROM orders WHERE o_orderkey % 5 <> 0),
li AS (SELECT l_orderkey AS k, l_linenumber AS line, max(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2),
o AS (SELECT k, line, k * 100 + line AS id, quantity, k * 10 AS parent_id FROM li WHERE line % 3 <> 0),
n AS (SELECT k, line, CASE WHEN k % 7 = 0 THEN quantity + 1 ELSE quantity END AS quantity, p.id AS parent_id FROM li LEFT JOIN p USING (k) WHERE line % 4 <> 0),
j AS (SELECT coalesce(o.k, n.k) AS k, coalesce(o.line, n.line) AS line, o.id, o.quantity AS oq, n.quantity AS nq, o.parent_id AS op, CASE WHEN n.k IS NOT NULL THEN coalesce(n.parent_id, o.parent_id) END AS np, o.k IS NULL AS fresh, n.k IS NULL AS gone FROM o FULL JOIN n ON o.k = n.k AND o.line = n.line)"""


@query(f"""WITH {LINKED} SELECT id, k, line, CASE WHEN gone THEN oq ELSE nq END AS quantity, CASE WHEN gone THEN op ELSE np END AS parent_id, NOT gone AS active, CASE WHEN gone THEN DATE '1999-01-01' END AS end_date,
CASE WHEN fresh THEN 'INSERT_NEW' WHEN gone THEN 'DELETE' WHEN oq IS DISTINCT FROM nq OR op IS DISTINCT FROM np THEN 'UPDATE' ELSE 'UNCHANGED' END AS action FROM j""")
def relinked_apply(spark, sf):
    """Plans that hang on versioned attributes: a merge moves those of a replaced version to the live one in the same pass."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line")).agg(F.max("l_quantity").alias("quantity"))
    parents = o.filter("o_orderkey % 5 <> 0").selectExpr("o_orderkey as k", "if(o_orderkey % 3 = 0, o_orderkey * 10 + 1, o_orderkey * 10) as id")
    old = li.filter("line % 3 <> 0").selectExpr("k * 100 + line as id", "k", "line", "quantity", "k * 10 as parent_id", "true as active", "cast(null as date) as end_date")
    new = li.filter("line % 4 <> 0").selectExpr("k", "line", "if(k % 7 = 0, quantity + 1, quantity) as quantity")
    return R.apply_linked(old, new, ["k", "line"], ["quantity"], parents, ["k"], "parent_id", merging.end())
