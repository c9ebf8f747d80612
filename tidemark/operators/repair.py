"""Set-based, repeatable backfills and repairs, with the counters that have to hold before a result is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds rank (1 stays, others are to be retired) and group_size. Blank keys count like null ones."""
    same = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    w = Window.partitionBy(*same)
    return df.withColumns({"rank": F.row_number().over(w.orderBy(*order)), "group_size": F.count("*").over(w)})


def retire(df: DataFrame, condition: Column, end_date: Column) -> DataFrame:
    """Active rows that meet the condition end; ``retired`` marks them for the audit log."""
    gone = F.col("active") & F.coalesce(condition, F.lit(False))
    return df.withColumn("retired", gone).withColumns({"active": F.col("active") & ~gone, "end_date": F.when(gone, end_date).otherwise(F.col("end_date"))})


def fill_nulls(df: DataFrame, staged: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Null values of active rows come from the staged row with the same keys (null keys equal null keys)."""
    one = staged.groupBy(*keys).agg(*(F.max(c).alias(f"__{c}") for c in columns)).select(*(F.col(k).alias(f"__k_{k}") for k in keys), *(f"__{c}" for c in columns))
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    told = df.join(one, same, "left")
    return told.withColumns({c: F.when(F.col("active"), F.coalesce(c, f"__{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def unique_value(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys and the column's value where a group has exactly one distinct value."""
    return df.groupBy(*keys).agg(F.count_distinct(column).alias("n"), F.min(column).alias(column)).filter("n = 1").drop("n")


def fill_unique(df: DataFrame, source: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Null values of active rows are filled where the source has exactly one value for their keys."""
    told = df.join(unique_value(source, keys, column).withColumnRenamed(column, "__one"), keys, "left")
    return told.withColumn(column, F.when(F.col("active"), F.coalesce(column, "__one")).otherwise(F.col(column))).drop("__one")


def retire_duplicates(df: DataFrame, keys: list[str], order: list[Column], end_date: Column) -> DataFrame:
    """The first row of each key stays, other active ones end; ``retired`` marks them for the audit log."""
    return retire(keep_latest(df, keys, order), F.col("rank") > 1, end_date)


def unpivoted(df: DataFrame, keys: list[str], columns: list[str], formats: tuple[str, ...]) -> DataFrame:
    """keys, name, day, error: one row for each wide column with a text, dates in any of the shapes."""
    long = df.unpivot(keys, columns, "name", "text").withColumn("text", F.nullif(F.trim("text"), F.lit(""))).filter("text is not null")
    day = F.coalesce(*(F.try_to_timestamp("text", F.lit(f)) for f in formats)).cast("date")
    return long.select(*keys, "name", day.alias("day"), F.when(day.isNull(), F.col("text")).alias("error"))


def seed(staged: DataFrame, present: DataFrame, domain: str, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the latest, for domains that have no rows yet."""
    fresh = staged.join(present.select(domain).distinct(), domain, "left_anti")
    return keep_latest(fresh, keys, order).filter("rank = 1").drop("rank", "group_size")


def relink(plans: DataFrame, attributes: DataFrame) -> DataFrame:
    """Active plans on ended attribute versions move to the one live version of the same code; the others say why not.

    plans: plan_id, attribute_id, active. attributes: id, domain, code, active.
    """
    linked = attributes.select(F.col("id").alias("attribute_id"), "domain", "code", F.col("active").alias("linked_active"))
    live = attributes.filter("active").groupBy("domain", "code").agg(F.count("*").alias("n_live"), F.min("id").alias("live_id"))
    told = plans.filter("active").join(linked, "attribute_id", "left").join(live, ["domain", "code"], "left")
    reason = (
        F.when(F.col("linked_active").isNull(), "UNKNOWN_ATTRIBUTE").when(F.col("linked_active"), "CURRENT")
        .when(F.col("n_live").isNull(), "NO_LIVE_VERSION").when(F.col("n_live") > 1, "SEVERAL_LIVE_VERSIONS").otherwise("MOVED")
    )
    return told.select("plan_id", "attribute_id", reason.alias("outcome"), F.when(reason == "MOVED", F.col("live_id")).otherwise(F.col("attribute_id")).alias("new_attribute_id"))


def guarded_rollback(current: DataFrame, backup: DataFrame, key: str, column: str, written: DataFrame) -> DataFrame:
    """Rows get their backed-up value where they still hold what the repair wrote; later changes stay."""
    told = current.join(backup.select(key, F.col(column).alias("__old")), key, "left").join(written.select(key, F.col(column).alias("__new")), key, "left")
    back = F.col("__new").isNotNull() & F.col(column).eqNullSafe(F.col("__new"))
    return told.withColumn("restored", back).withColumn(column, F.when(back, F.col("__old")).otherwise(F.col(column))).drop("__old", "__new")


def backup_once(df: DataFrame, path: str) -> bool:
    """Writes a copy unless there is one; whether it wrote."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return False
    df.write.parquet(path)
    return True


def verified(before: DataFrame, after: DataFrame, key: str, column: str, expected: DataFrame) -> DataFrame:
    """One row of counters and ``ok``: what changed is what was expected, and no active row came or went."""
    told = before.select(key, F.col(column).alias("o"), F.col("active").alias("was")).join(after.select(key, F.col(column).alias("n"), F.col("active").alias("is")), key, "full_outer")
    counts = told.agg(F.count_if(~F.col("o").eqNullSafe(F.col("n"))).alias("n_changed"), F.count_if(F.coalesce("was", F.lit(False))).alias("n_active_before"), F.count_if(F.coalesce("is", F.lit(False))).alias("n_active_after"))
    return counts.withColumn("n_expected", expected.agg(F.count("*")).scalar()).withColumn("ok", F.expr("n_changed = n_expected and n_active_before = n_active_after"))


def catalogue_upsert(catalogue: DataFrame, wanted: DataFrame, id_col: str, name: str) -> DataFrame:
    """id, name, outcome: INSERT new ids, PRESENT equal ones, CONFLICT where an id has another name."""
    told = wanted.join(catalogue.select(F.col(id_col), F.col(name).alias("__have")), id_col, "left")
    return told.select(id_col, name, F.when(F.col("__have").isNull(), "INSERT").when(F.col("__have") == F.col(name), "PRESENT").otherwise("CONFLICT").alias("outcome"))


def evolve(df: DataFrame, rename: dict[str, str] | None = None, cast: dict[str, str] | None = None, add: dict[str, Column] | None = None) -> DataFrame:
    """Renames, casts and adds columns; a cast that would lose a value gives an error when the rows are read."""
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    for c, kind in (cast or {}).items():
        lost = F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
        df = df.withColumn(c, F.when(lost, F.raise_error(F.concat(F.lit(f"{c} does not fit {kind}: "), F.col(c).cast("string"))).cast(kind)).otherwise(F.col(c).try_cast(kind)))
    return df.withColumns(add or {})


def missing_in_staging(governed: DataFrame, staged: DataFrame, keys: list[str], group: str) -> DataFrame:
    """group, n: active governed rows that no staged row equals."""
    return governed.filter("active").join(staged.select(*keys).distinct(), keys, "left_anti").groupBy(group).agg(F.count("*").alias("n"))
