"""Readers see a table whole: before, during and after a change, and when a change fails."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom.sinks import tables, versions

SCHEMA = "k int, part string, at int"
START = [(1, "a", 1), (2, "a", 1), (3, "b", 1), (4, None, 1), (5, "it's */ \\ odd", 1)]


@pytest.fixture
def name(spark):
    schema = f"loom_{uuid.uuid4().hex}"
    tables.create_schema(spark, schema)
    yield f"{schema}.t"
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


@pytest.fixture
def table(spark, name):
    """A table of five rows, and a way to make rows for it."""
    assert versions.replace(spark.createDataFrame(START, SCHEMA), name, "part") == 5
    return name, lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def stored(spark, name):
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN {name.split('.')[0]}").collect() if r.tableName.startswith("t_g")}


def test_replace_in_full(spark, table, rows):
    name, make = table
    reader = spark.table(name)
    assert rows(reader) == rows(make(*START))
    assert versions.replace(spark.createDataFrame([("x", 7)], "part string, other int"), name, "part") == 1
    assert spark.table(name).columns == ["part", "other"] and rows(spark.table(name)) == [("x", 7)]
    assert rows(reader) == rows(make(*START))  # the generation before is still there for it
    versions.replace(make((9, "c", 9)), name, "part")
    assert len(stored(spark, name)) == 2


def test_partitions_are_replaced_alone(spark, table, rows):
    name, make = table
    (first,) = stored(spark, name)
    assert versions.replace_partitions(make((1, "a", 5)), name, "part", ["a", "b"]) == 1
    now = versions.versions_of(spark, name)
    assert sorted(now.held[f"{name.split('.')[0]}.{first}"], key=str) == [None, "it's */ \\ odd"] and len(now.held) == 2
    assert rows(spark.table(name)) == rows(make((1, "a", 5), START[3], START[4]))
    versions.replace_partitions(make((4, None, 2)), name, "part", [None])
    assert rows(spark.table(name)) == rows(make((1, "a", 5), (4, None, 2), START[4]))
    versions.replace_partitions(make().where("false"), name, "part", now.values())
    assert rows(spark.table(name)) == [] and spark.table(name).columns == ["k", "part", "at"]
    versions.replace_partitions(make(*START), name, "part", {p for _, p, _ in START})
    assert rows(spark.table(name)) == rows(make(*START))
    with pytest.raises(ValueError, match="other partitions"):
        versions.replace_partitions(make((1, "z", 5)), name, "part", ["a"])
    with pytest.raises(ValueError, match="has columns"):
        versions.replace_partitions(make((1, "a", 5)).drop("at"), name, "part", ["a"])
    assert rows(spark.table(name)) == rows(make(*START))


def test_upsert(spark, table, rows):
    name, make = table
    changes = make((2, "a", 3), (2, "a", 2), (6, "c", 1), (4, None, 0), (4, None, 4))
    expected = rows(make((1, "a", 1), (2, "a", 3), (3, "b", 1), (4, None, 4), (5, START[4][1], 1), (6, "c", 1)))
    for _ in range(3):
        assert versions.upsert(changes, name, ["k", "part"], ["at"]) == 4
        assert rows(spark.table(name)) == expected
    assert versions.upsert(changes.where("false"), name, ["k", "part"], ["at"]) == 0
    with pytest.raises(ValueError, match="column of the key"):
        versions.upsert(changes, name, ["k"], ["at"])


@pytest.mark.parametrize("change", ["upsert", "replace", "partitions"])
@pytest.mark.parametrize("where", ["rows", "switch"])
def test_a_change_that_breaks_leaves_the_old_rows_whole(spark, table, rows, monkeypatch, change, where):
    """It breaks while rows are written, or at the last step; run again, it goes through."""
    name, make = table
    good = make((1, "a", 9), (3, "b", 9))
    bad = good.withColumn("at", F.when(F.col("k") == 3, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("at")))
    run = {
        "upsert": lambda df: versions.upsert(df, name, ["k", "part"], ["at"]),
        "replace": lambda df: versions.replace(df, name, "part"),
        "partitions": lambda df: versions.replace_partitions(df, name, "part", ["a", "b"]),
    }[change]
    with monkeypatch.context() as broken:
        if where == "switch":
            broken.setattr(versions, "_switch", lambda *a: (_ for _ in ()).throw(OSError("broken")))
        with pytest.raises((PySparkException, OSError), match="broken"):
            run(bad if where == "rows" else good)
    assert rows(spark.table(name)) == rows(make(*START))
    run(good)
    others = {"upsert": [START[1], START[3], START[4]], "replace": [], "partitions": [START[3], START[4]]}[change]
    assert rows(spark.table(name)) == rows(make((1, "a", 9), (3, "b", 9), *others))


def test_newest_partition_without_a_scan(spark, name, rows):
    days = spark.range(40).selectExpr("id", "date_add(date'2026-01-01', cast(id % 8 as int)) as day")
    versions.replace(days, name, "day")
    last = versions.newest(spark, name)
    assert rows(last.select("id")) == sorted([(i,) for i in range(7, 40, 8)], key=lambda r: str(r[0]))
    files = {r.f for r in last.select(F.input_file_name().alias("f")).collect()}
    scan = [line for line in last._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert all("day=2026-01-08" in f for f in files) and len(scan) == 1 and "PartitionFilters" in scan[0]
    assert len(last.inputFiles()) == len(files)
    numbers = spark.range(12).selectExpr("id", "cast(id as int) as n")
    versions.replace(numbers, name, "n")
    assert rows(versions.newest(spark, name)) == [(11, 11)]  # by value, not by text


def test_other_views_are_refused(spark, name):
    spark.sql(f"CREATE VIEW {name} AS SELECT 1 AS part")
    with pytest.raises(ValueError, match="not as a view of generations"):
        versions.versions_of(spark, name)
    assert versions.versions_of(spark, name + "_none") is None
