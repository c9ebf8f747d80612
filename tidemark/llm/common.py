"""Helpers that the operators share: input tables, Arrow batches, tables in the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow types by the names that Spark's DDL has for them.
ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}
#: Rows of one Arrow batch that goes back to Spark: long texts stay a few tens of MB.
OUT_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def find_package(spark: SparkSession) -> None:
    """Local workers look for this package where the driver has it; a cluster installs it or gets --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    have = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"`{k}` {v}" for k, v in schema.items())


def batch(schema: dict[str, str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, ARROW[t]) for c, t in zip(columns, schema.values(), strict=True)], names=list(schema))


def map_rows(df: DataFrame, columns: list[str], schema: dict[str, str], make: Callable[[], Callable]) -> DataFrame:
    """Runs make()(*lists of columns) on slices of Arrow batches; make is called once a task, its result gives the output's columns.

    Only the named columns are read, so other columns, clashing names included, play no part.
    """
    find_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for at in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(at, OUT_ROWS)
                if part.num_rows:
                    yield batch(schema, f(*(c.to_pylist() for c in part.columns)))

    return df.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, ddl(schema))


#: Temporary folders of applications that name none.
OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all machines share (spark.checkpoint.dir); where it is unset, a temporary one in local mode, an error
    on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = OWN_FOLDERS.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="spark-checkpoint-")
        OWN_FOLDERS[spark.sparkContext.applicationId] = base
    return f"{base}/{uuid.uuid4().hex}"


class Blocks(threading.local):
    """Tables of the ``scratch`` blocks that are open in this thread: threads of one driver don't delete each other's."""

    def __init__(self):
        self.open: list[list[str]] = []


SCRATCH = Blocks()
#: Names in the catalogue of tables in buckets, by path.
BUCKETED: dict[str, str] = {}


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside are deleted at the end, but for those with ``keep``. Gives the list of their paths."""
    SCRATCH.open.append([])
    try:
        yield SCRATCH.open[-1]
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in SCRATCH.open.pop():
            if path in BUCKETED:
                spark.sql(f"DROP TABLE IF EXISTS {BUCKETED.pop(path)}")
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


#: Shuffle files go when the job that wrote them ends: what is used again lies in tables.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)


def written(df: DataFrame, keep: bool = False) -> DataFrame:
    """df as a table in the shared folder: it is computed once, and survives the loss of any executor. keep: past the ``scratch`` block."""
    path = shared_folder(df.sparkSession)
    if len(SCRATCH.open) > keep:
        SCRATCH.open[-1 - keep].append(path)
    with cleaned(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str]) -> DataFrame:
    """As ``written``, in buckets of these columns: joins by them deal out the other side only."""
    spark = df.sparkSession
    path, name = shared_folder(spark), f"bucketed_{uuid.uuid4().hex}"
    if SCRATCH.open:
        SCRATCH.open[-1].append(path)
        BUCKETED[path] = name
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with cleaned(spark):
        df.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)
