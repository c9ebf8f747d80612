"""Sheets and files: contract scans, control blocks, slice-replacing snapshots, aligned projections, event and nested sinks."""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .versions import Part, Store


@dataclass(frozen=True)
class Contract:
    """What a sheet must have; everything is read as text and typed later by rules."""

    name: str
    columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    key: str | None = None
    by_prefix: bool = False
    inherits_key: bool = False
    dates: dict[str, str] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)
    #: Columns that are whole numbers.
    whole: tuple[str, ...] = ()


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all machines share (spark.checkpoint.dir); where it is unset, in the warehouse in local mode, an error on
    a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/{uuid.uuid4().hex}"


def kept(df: DataFrame, *by: str) -> DataFrame:
    """df as a table in the shared folder, in folders by these columns: it is computed once, and survives the loss of any executor."""
    path = shared_folder(df.sparkSession)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    schema = StructType([*(f for f in df.schema if f.name not in by), *(df.schema[c] for c in by)])
    return df.sparkSession.read.schema(schema).parquet(path)


def find_package(spark: SparkSession) -> None:
    """Local workers look for this package where the driver has it; a cluster installs it or gets --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    have = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def scan(spark: SparkSession, path: str, contract: Contract, kind: str = "csv", **options: str) -> DataFrame:
    """The declared columns as text with ``_file``; header names are stripped, others ignored, missing ones an error; blank rows go."""
    reader = spark.read.options(**({"header": "true"} if kind == "csv" else {}) | options)
    df = reader.format(kind).load(path)
    names = {c.strip(): c for c in df.columns}
    if missing := [c for c in contract.columns if c not in names]:
        raise ValueError(f"{contract.name}: missing columns {', '.join(missing)}")
    told = df.select(*(F.col(f"`{names[c]}`").cast("string").alias(c) for c in contract.columns), F.col("_metadata.file_name").alias("_file"))
    return told.dropna(how="all", subset=list(contract.columns))


def settled_files(spark: SparkSession, path: str, pattern: str, before: str | None = None) -> DataFrame:
    """file, modified, length, hash of files that are not empty, no lock files (``~$``), and older than ``before`` (a timestamp)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if before:
        reader = reader.option("modifiedBefore", before)
    df = reader.load(path).withColumn("file", F.element_at(F.split("path", "/"), -1))
    return df.filter("length > 0 and not startswith(file, '~$')").select("file", F.col("modificationTime").alias("modified"), "length", F.sha2("content", 256).alias("hash"))


#: The keys of a control block.
CONTROL = ("template", "version", "domain", "base_load", "created")


def control_blocks(rows: DataFrame) -> DataFrame:
    """rows(file, key, value) of two-column sheets: one record a file; a base load that is no number is null."""
    clean = rows.select("file", F.trim("key").alias("key"), F.trim("value").alias("value")).filter("key <> ''")
    wide = clean.groupBy("file").pivot("key", list(CONTROL)).agg(F.min("value"))
    return wide.withColumn("base_load", F.when(F.col("base_load").rlike("^[0-9]+$"), F.col("base_load").try_cast("bigint")))


def in_slice(key: str, value: Column, by_prefix: bool = False) -> Column:
    """Rows of a domain: by equality, or by the literal prefix ``domain-`` of a composite code."""
    return F.startswith(F.col(key), F.concat(value, F.lit("-"))) if by_prefix else F.col(key) == value


def replace_slices(current: DataFrame, batch: DataFrame, touched: DataFrame, key: str = "domain", by_prefix: bool = False) -> DataFrame:
    """The next snapshot: touched slices come from the batch alone, even where it has none of their rows; the others stay.

    by_prefix: keys are composite codes, whose slice is what stands before the last hyphen.
    """
    slice_of = F.regexp_extract(key, "^(.*)-[^-]*$", 1) if by_prefix else F.col(key)
    slices = touched.select(F.col(touched.columns[0] if by_prefix else key).alias("__slice")).distinct()
    return current.join(slices, slice_of == F.col("__slice"), "left_anti").unionByName(batch.join(slices, slice_of == F.col("__slice"), "left_semi"), allowMissingColumns=True)


def publish_snapshot(df: DataFrame, root: str) -> int:
    """Replaces the whole table at ``root`` and gives its version: readers see the old or the new table, never half of one or none, and of
    two writers that have read the same version one gets ``versions.Conflict``."""
    store = Store(df.sparkSession, root)
    return store.publish([Part("rows", df)], store.latest()).number


def current_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return Store(spark, root).read("rows")


def stamped(df: DataFrame, id_load: int | None) -> DataFrame:
    return df if id_load is None else df.withColumn("id_load", F.lit(id_load).cast("bigint"))


def aligned(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """df with the target's columns by name; gives also the new (null) and the lost columns."""
    new, lost = [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns)), new, lost


def rebuildable(staged: DataFrame, last_good: DataFrame) -> DataFrame:
    """domain, last_id, other_ids, ok: a load can be rebuilt from staging only if all its domain's rows carry its id."""
    ids = staged.groupBy("domain").agg(F.collect_set(F.coalesce("id_load", F.lit(-1).cast("bigint"))).alias("ids"))
    others = F.array_sort(F.array_except("ids", F.array("last_id")))
    return last_good.join(ids, "domain", "left").select("domain", "last_id", F.array_join(others.cast("array<string>"), ",").alias("other_ids"), F.coalesce(F.size(others) == 0, F.lit(False)).alias("ok"))


def with_fallback(wanted: DataFrame, archived: DataFrame, staged: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The archived value first, else the staged one; ``source`` says which, null where there is none."""
    told = wanted.join(archived.select(*keys, F.col(column).alias("__a")), keys, "left").join(staged.select(*keys, F.col(column).alias("__s")), keys, "left")
    return told.withColumns({column: F.coalesce("__a", "__s"), "source": F.when(F.col("__a").isNotNull(), "archive").when(F.col("__s").isNotNull(), "staging")}).drop("__a", "__s")


def events(results: DataFrame) -> DataFrame:
    """One JSON record for each processed file: all its columns."""
    return results.select(F.to_json(F.struct(*results.columns)).alias("value"))


def write_events(results: DataFrame, path: str) -> None:
    events(results).write.mode("append").text(path)


def write_relations(drawn: DataFrame, undrawn: DataFrame, path: str) -> None:
    drawn.unionByName(undrawn, allowMissingColumns=True).write.mode("overwrite").options(sep=";", quoteAll="true", header="true").csv(path)


def write_sections(model: DataFrame, sections: dict[str, list[str]], path: str) -> None:
    """The nested model, for each section with the columns that it uses, one folder a section."""
    for name, columns in sections.items():
        model.select(*columns).write.mode("overwrite").json(f"{path}/section={name}")
