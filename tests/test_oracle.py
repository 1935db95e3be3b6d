"""Every query against DuckDB on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from fixtures import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{os.path.join(sf_dir, name)}.parquet'")
    return con


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = duck.sql(ORACLE[name])
    assert sorted(wanted.columns) == columns
    types = dict(zip(wanted.columns, map(str, wanted.types)))
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    picked = ", ".join(f'"{c}"' for c in columns)
    rows = duck.sql(f"select {picked} from ({ORACLE[name]})").fetchall()
    assert rows, "the scenario gives no rows"
    assert ordered(found.select(*columns).collect()) == ordered(rows)


def test_entry(spark):
    rows = {r["status"]: r["n"] for r in entry_points.entry(spark).collect()}
    assert set(rows) == {"MATCH", "DIFFERENT", "MISSING_AT_DEST", "EXTRA_AT_DEST"}
