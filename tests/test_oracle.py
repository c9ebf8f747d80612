"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def cell(v):
    if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
        return "null"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, str):
        return v
    return f"{float(v):.9g}"


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted("|".join(map(cell, r)) for r in df[columns].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(name, spark, duck):
    assert rows(entry.queries()[name](spark, SF).toPandas()) == rows(duck.sql(entry.oracle_sql()[name]).df())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_wide_rows_of_odd_tables_as_sql(spark, tmp_path):
    """Orders that are there twice, in two domains, in an inactive and a published one, or have no customer; lines without order; parts,
    suppliers and customers that are there twice."""
    c = duckdb.connect()
    for t in ("region", "nation"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    few = {"orders": "o_orderkey % 5 = 0", "lineitem": "l_orderkey % 4 = 0", "part": "p_partkey < 3", "supplier": "s_suppkey < 3", "customer": "c_custkey < 3"}
    changes = {
        "orders": ["o_custkey + 0 AS o_custkey", "(o_custkey + 1) % 100 AS o_custkey", "(o_custkey + 7) % 100 AS o_custkey", "NULL AS o_custkey"],
        "lineitem": ["NULL AS l_orderkey", "-1 AS l_orderkey"], "part": ["'other' AS p_name"], "supplier": ["'other' AS s_name"], "customer": ["4 AS c_nationkey"],
    }
    for t, where in few.items():
        more = "".join(f" UNION ALL SELECT x.* REPLACE ({change}) FROM '{SF}/{t}.parquet' x WHERE {where}" for change in changes[t])
        c.sql(f"COPY (SELECT * FROM '{SF}/{t}.parquet'{more}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    for t in ("region", "nation", *few):
        c.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    got = rows(entry.queries()["explorer_wide"](spark, str(tmp_path)).toPandas())
    assert got == rows(c.sql(entry.oracle_sql()["explorer_wide"]).df()) and len(got[1]) > 1000
