"""Every registered query against its SQL, run by an independent engine."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from panelloom.catalogue import ORACLES, QUERIES, load_catalogue

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean"}

load_catalogue()

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"]


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    columns = sorted(df.columns)
    names = [d[0] for d in expected.description]
    assert columns == sorted(names)
    assert dict(df.dtypes) == {d[0]: TYPES[str(d[1])] for d in expected.description}
    found = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    wanted = sorted((tuple(r[names.index(c)] for c in columns) for r in expected.fetchall()), key=repr)
    assert found == wanted
    assert found, "a query that returns nothing checks nothing"
    plan = df._jdf.queryExecution().toString()
    assert not [node for node in FORBIDDEN if node in plan]


def test_entry_runs(spark):
    assert contract.entry(spark).columns[:4] == ["fund_name", "abn", "fund_type", "quarter_date"]
