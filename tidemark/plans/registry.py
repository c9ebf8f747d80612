"""Queries by name, each with the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task takes where they are dealt out by a key.
TASK_ROWS = 250_000


def parts(df: DataFrame) -> int:
    """In how many parts a table is dealt out, so that a task's share is the same however large the table: its rows are counted, which
    Parquet files tell without being read."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def at_hand(df: DataFrame) -> DataFrame:
    """A catalogue that every task gets whole if it has no more rows than a task takes, so that what looks it up is not shuffled for it."""
    return F.broadcast(df) if df.count() <= TASK_ROWS else df
