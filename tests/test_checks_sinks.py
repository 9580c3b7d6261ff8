"""Checks, writes, bounded questions and the whole run."""

from __future__ import annotations

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from panelloom.operators import checks
from panelloom.plans import selects
from panelloom.plans.weekly import load_all, weekly_run
from panelloom.session import fresh_path, scratch_folder, write_through
from panelloom.sinks import tables
from panelloom.sources.snapshots import read_snapshot
from panelloom.standins.workbooks import landed

D1, D2 = date(2026, 1, 5), date(2026, 1, 12)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "x", 5), (1, "y", 5), (2, None, 6), (None, "z", None)], "id int, kind string, total int")


def test_row_checks_in_one_pass(people, rows):
    found = checks.row_checks(people, "people", ["id", "total"], {"kind": ["x", "y"]}, (1, 3))
    assert rows(found) == [
        ("people", "*", "row_count", 1),
        ("people", "id", "not_null", 1),
        ("people", "kind", "accepted_values", 1),
        ("people", "total", "not_null", 1),
    ]
    assert rows(checks.row_checks(people.limit(0), "none", ["id"], row_count=(1, None)), "failures") == [(0,), (1,)]


def test_null_passes_accepted_unique_and_relationships(people, rows, spark):
    assert rows(checks.unaccepted(people, "kind", ["x", "y"])) == [("z", 1)]
    assert rows(checks.duplicates(people, ["id"])) == [(1, 2)]
    parents = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert rows(checks.orphans(people, "id", parents, "key"), "id") == [(2,)]


def test_grain_conflicts(people, rows, spark):
    assert rows(checks.grain_conflicts(people, ["id"], ["total"])) == []
    more = people.union(spark.createDataFrame([(2, "x", None), (1, "x", 9)], people.schema))
    assert rows(checks.grain_conflicts(more, ["id"], ["total"])) == [(1,), (2,)]


def test_gate_raises_on_any_failure(people):
    good = checks.row_checks(people, "people", ["id"]).withColumn("failures", F.lit(0).cast("bigint"))
    assert len(checks.gate(good)) == 1
    bad = checks.as_result(checks.duplicates(people, ["id"]), "people", "id", "unique")
    with pytest.raises(checks.ChecksFailed, match="people.id unique: 1"):
        checks.gate(checks.report(good, bad))


def test_archive_keeps_other_dates_and_reloads_one(spark, rows):
    root = fresh_path(spark, "archive")
    cells = spark.createDataFrame([("f", "s", 0, 0, ["a"], "k1"), ("g", "s", 0, 0, ["b"], "k2")], "file string, sheet string, sheet_pos int, row_idx int, cells array<string>, dataset string")
    assert tables.archive(cells, root, D1) == [f"{root}/run_date=2026-01-05/dataset={k}" for k in ("k1", "k2")]
    for _ in range(2):
        tables.archive(cells.where("dataset = 'k1'"), root, D2)
    assert rows(read_snapshot(spark, root, D1), "file", "dataset") == [("f", "k1"), ("g", "k2")]
    assert rows(read_snapshot(spark, root, D2), "file", "dataset") == [("f", "k1")]
    assert read_snapshot(spark, root, D1, "k2").count() == 1
    plan = read_snapshot(spark, root, D1, "k2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_upsert_later_row_wins_and_repeats_change_nothing(spark, rows):
    path = fresh_path(spark, "table")
    schema = "k int, part string, at int, v string"
    start = spark.createDataFrame([(1, "a", 1, "old"), (2, "a", 1, "kept"), (3, "b", 1, "far")], schema)
    tables.start_table(start, path, "part")
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "part=b" in f}
    updates = spark.createDataFrame([(1, "a", 2, "new"), (1, "a", 0, "late"), (4, "c", 1, "first")], schema)
    expected = [(1, "a", 2, "new"), (2, "a", 1, "kept"), (3, "b", 1, "far"), (4, "c", 1, "first")]
    for _ in range(2):
        tables.upsert(spark, updates, path, ["k", "part"], ["at"], "part")
        found = spark.read.schema(start.schema).parquet(path)
        assert rows(found, "k", "part", "at", "v") == expected
    assert untouched <= set(found.inputFiles())
    with pytest.raises(ValueError):
        tables.upsert(spark, updates, path, ["k"], ["at"], "part")


def test_upsert_into_many_partitions(spark, rows):
    path = fresh_path(spark, "table")
    start = spark.createDataFrame([(i, i % 5, 1) for i in range(20)], "k int, part int, at int")
    tables.start_table(start, path, "part")
    tables.upsert(spark, start.where("part < 3").withColumn("at", F.lit(2)), path, ["k", "part"], ["at"], "part")
    assert rows(spark.read.parquet(path).groupBy("at").count()) == [(1, 8), (2, 12)]


def test_latest_per_key_of_a_hot_key(spark, rows):
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 4)) as key", "id as at", "id * 2 as v")
    assert rows(tables.latest_per_key(df, ["key"], ["at"])) == [
        ("hot", 9999, 19998), ("k0", 9992, 19984), ("k1", 9997, 19994), ("k2", 9998, 19996), ("k3", 9995, 19990)
    ]


def test_replace_and_counted_writes(spark, people):
    schema = f"loom_{uuid.uuid4().hex}"
    tables.create_schema(spark, schema)
    tables.create_schema(spark, schema)
    assert tables.replace_table(people, f"{schema}.t") == 4
    assert tables.replace_table(people.select("id").limit(2), f"{schema}.t") == 2
    assert spark.table(f"{schema}.t").columns == ["id"]
    assert tables.write_counted(people, fresh_path(spark, "out")) == 4


@pytest.fixture
def numbers(spark):
    spark.range(201).createOrReplaceTempView("numbers")
    return "numbers"


def test_two_hundred_of_two_hundred_and_one(spark, numbers):
    whole = selects.answer(spark, "select id from numbers where id < 200", "how many?", readable=["numbers"])
    assert (whole.row_count, whole.truncated, whole.columns, whole.question) == (200, False, ["id"], "how many?")
    cut = selects.answer(spark, "  SELECT id FROM numbers", readable=["numbers"])
    assert (cut.row_count, cut.truncated, len(cut.results)) == (200, True, 200)
    count = selects.select(spark, "with n as (select * from numbers) select count(*) as c from n", readable=["numbers"])
    assert count.collect()[0]["c"] == 201


@pytest.mark.parametrize("text", ["delete from numbers", "drop table numbers", "", "   ", "selection", "explain select 1"])
def test_only_reading_queries_run(spark, text):
    with pytest.raises(selects.Refused):
        selects.answer(spark, text)


def test_one_statement_with_its_semicolon_runs(spark, numbers):
    assert selects.answer(spark, "select 1 as a -- one\n;").results == [{"a": 1}]
    with pytest.raises(selects.Refused):
        selects.answer(spark, "select 1; drop view numbers")


@pytest.mark.parametrize("text", ["insert into {t} select a from n", "from n insert into {t} select a"])
def test_a_with_that_writes_is_refused_before_it_writes(spark, text):
    schema = f"loom_{uuid.uuid4().hex}"
    tables.create_schema(spark, schema)
    tables.replace_table(spark.range(2), f"{schema}.t")
    with pytest.raises(selects.Refused):
        selects.answer(spark, "with n as (select 9 as a) " + text.format(t=f"{schema}.t"))
    assert spark.table(f"{schema}.t").count() == 2


def test_catalog_follows_the_schemas(people, rows):
    found = selects.catalog({"people": people})
    assert rows(found) == [("people", "id", "int", 1, 3), ("people", "kind", "string", 2, 3), ("people", "total", "int", 3, 3)]


REGIONS = ["africa", "america", "asia", "europe", "middle east"]


def test_whole_run_and_its_gate(spark):
    root, raw, mart = fresh_path(spark, "archive"), *[f"loom_{uuid.uuid4().hex}" for _ in range(2)]
    cells = write_through(landed(spark, SF_DIR), "landed")
    at = datetime(2026, 1, 5, 22)
    run = weekly_run(spark, cells, root, D1, at, raw, mart, REGIONS)
    assert len(run.archived) == 3 and all(c["failures"] == 0 for c in run.checks)
    assert run.rows[f"{raw}.product_quarterly"] == spark.table("staging").count() > 0
    assert {r["_run_date"] for r in spark.table(f"{raw}.fund_quarterly").select("_run_date").distinct().collect()} == {D1}
    with pytest.raises(checks.ChecksFailed, match="staging.fund_type accepted_values"):
        weekly_run(spark, cells, root, D2, at, raw, mart, REGIONS[:2])
    assert load_all(spark, root, D1, at, raw, ["annual_bulletin"]) == {f"{raw}.annual_bulletin": 200}


def test_scratch_lies_in_the_shared_folder_and_can_be_released(spark):
    folder = scratch_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = write_through(spark.range(3), "kept")
    assert kept.inputFiles()[0].removeprefix("file://").startswith(folder)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
