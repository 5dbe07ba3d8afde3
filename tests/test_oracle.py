"""Every registered query against its SQL counterpart in DuckDB."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tickloom.oracle import ORACLE as SQL
from tickloom.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# the smallest tables hold no duplicate keys
EMPTY_WHEN_SMALL = {"duplicate_audit", "worst_duplicates"}
# spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    kinds = dict(zip(result.columns, map(str, result.types)))
    assert {n: TYPES[k] for n, k in df.dtypes} == kinds
    picked = ", ".join(f'"{c}"' for c in columns)
    want = Counter(duck.sql(f"SELECT {picked} FROM ({SQL[name]})").fetchall())
    assert sum(got.values()) == sum(want.values())
    assert not (got - want), list((got - want).items())[:3] + list((want - got).items())[:3]
    assert got or name in EMPTY_WHEN_SMALL


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)
