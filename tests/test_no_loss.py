"""What must not get lost: cells, columns, partitions, data sets; and ranks of any ordered type."""

from __future__ import annotations

import math
import uuid
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.operators.frames import preview
from panelloom.operators.ranking import Ranking, exact_medians, with_rankings
from panelloom.plans import marts, selects
from panelloom.plans.merge import merge_sheets
from panelloom.plans.weekly import load_all, weekly_run
from panelloom.session import fresh_path, scratch_folder, scratch_scope, write_through
from panelloom.sinks import tables
from panelloom.sources import sheets
from panelloom.sources.snapshots import read_snapshot
from panelloom.standins.workbooks import landed

CELLS = "file string, sheet string, sheet_pos int, row_idx int, cells array<string>"
D1 = date(2026, 1, 5)
AT = datetime(2026, 1, 5, 22)


@pytest.fixture
def book(spark):
    def build(*lines, sheet="Data"):
        return spark.createDataFrame([("f", sheet, 0, i, cells) for i, cells in enumerate(lines)], CELLS)

    return build


@pytest.mark.parametrize(
    "lines,columns,row",
    [
        ([["a", "b"], ["1", "2", "3"]], ["a", "b", "Unnamed: 2"], ("1", "2", "3")),
        ([["Total assets", "Total  assets", "x"], ["1", "2", "3"]], ["Total assets", "Total assets.1", "x"], ("1", "2", "3")),
        ([["a", "a", "a.1"], ["1", "2", "3"]], ["a", "a.2", "a.1"], ("1", "2", "3")),
        ([["a", None, None, "a"], ["1", "2", "3", "4"]], ["a", "Unnamed: 1", "Unnamed: 2", "a.1"], ("1", "2", "3", "4")),
    ],
)
def test_every_column_survives(book, lines, columns, row):
    table = sheets.first_sheet_table(book(*lines))
    assert table.columns == columns and [tuple(r) for r in table.collect()] == [row]


def test_names_equal_after_cleaning_survive(book):
    table = sheets.detected_table(book(["Fee %", "Fee $", "b", "c"], ["1", "2", "3", "4"]))
    assert table.columns == ["file", "fee", "fee.1", "b", "c"] and table.first()[1:3] == ("1", "2")


def test_cells_beyond_the_header_are_listed(book, rows):
    cells = book(["a"], ["1", "2"], [None, None, "3"])
    found = sheets.long_cells(cells, sheets.header_names(cells, 0)).where("value is not null")
    assert rows(found, "row_idx", "name", "value") == [(1, "Unnamed: 1", "2"), (1, "a", "1"), (2, "Unnamed: 2", "3")]


def test_missing_sheets_raise(book):
    with pytest.raises(ValueError, match="has no sheet"):
        merge_sheets(book(["x"], sheet="Table 2a"))
    with pytest.raises(ValueError, match="no data sheet"):
        sheets.detected_table(book(["a", "b", "c", "d"], sheet=" Cover"))


def test_a_sheet_wider_than_a_sheet_raises(book, monkeypatch):
    monkeypatch.setattr(sheets, "MAX_COLUMNS", 2)
    with pytest.raises(ValueError, match="more than 2 columns"):
        sheets.first_sheet_table(book(["a", "b", "c"]))


def test_upsert_keeps_the_null_partition(spark, rows):
    path = fresh_path(spark, "table")
    start = spark.createDataFrame([(1, None, 1), (2, None, 1), (3, "a", 1)], "k int, part string, at int")
    tables.start_table(start, path, "part")
    tables.upsert(spark, spark.createDataFrame([(1, None, 2)], start.schema), path, ["k", "part"], ["at"], "part")
    assert rows(spark.read.schema(start.schema).parquet(path), "k", "part", "at") == [(1, None, 2), (2, None, 1), (3, "a", 1)]


def test_upsert_of_other_columns_raises(spark):
    path = fresh_path(spark, "table")
    start = spark.createDataFrame([(1, "a", 1, "kept")], "k int, part string, at int, extra string")
    tables.start_table(start, path, "part")
    for other in (start.drop("extra"), start.withColumn("more", F.lit(1)), start.withColumn("at", F.lit("x"))):
        with pytest.raises(ValueError, match="columns"):
            tables.upsert(spark, other, path, ["k", "part"], ["at"], "part")
    assert spark.read.parquet(path).first()["extra"] == "kept"


def test_absent_snapshots_raise_before_anything_is_replaced(spark):
    root, schema = fresh_path(spark, "archive"), f"loom_{uuid.uuid4().hex}"
    cells = spark.createDataFrame([("f", "s", 0, 0, ["a"], "fund_quarterly")], CELLS + ", dataset string")
    tables.archive(cells, root, D1)
    tables.create_schema(spark, schema)
    tables.replace_table(spark.range(3), f"{schema}.fund_quarterly")
    for run_date, keys in ((date(2030, 1, 1), ["fund_quarterly"]), (D1, ["fund_quarterly", "annual_bulletin"])):
        with pytest.raises(AnalysisException):
            load_all(spark, root, run_date, AT, schema, keys)
    assert spark.table(f"{schema}.fund_quarterly").count() == 3
    with pytest.raises(PySparkException, match="no data set"):
        tables.archive(cells.withColumn("dataset", F.lit(None).cast("string")), root, D1)
    with pytest.raises(AnalysisException):
        read_snapshot(spark, root, D1, "nothing")


def test_run_needs_every_data_set(spark):
    root, raw, mart = fresh_path(spark, "archive"), *[f"loom_{uuid.uuid4().hex}" for _ in range(2)]
    cells = write_through(landed(spark, "/root/testdata/sf0.001"), "landed")
    some = cells.where("dataset != 'product_quarterly'")
    other = cells.withColumn("dataset", F.lit("unknown"))
    for bad in (some, other, cells.withColumn("dataset", F.lit(None).cast("string")), cells.limit(0)):
        with pytest.raises(ValueError, match="landed data sets"):
            weekly_run(spark, bad, root, D1, AT, raw, mart)
    run = weekly_run(spark, some, root, D1, AT, raw, mart, left_out=["product_quarterly"])
    assert set(run.rows) == {f"{raw}.fund_quarterly", f"{raw}.annual_bulletin"} and not run.checks


def test_scratch_goes_at_the_end_of_a_scope(spark):
    kept = write_through(spark.range(2), "kept")
    with pytest.raises(RuntimeError), scratch_scope(spark):
        gone = write_through(spark.range(2), "gone").inputFiles()[0]
        raise RuntimeError
    assert not Path(gone.removeprefix("file:").replace("//", "/")).exists() and kept.count() == 2


def test_scratch_without_a_checkpoint_folder_lies_in_the_warehouse():
    settings = {"spark.sql.warehouse.dir": "hdfs://lake/warehouse/"}
    context = SimpleNamespace(applicationId="app", master="local[2]", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=context)
    session.conf.get = lambda key, default=None: settings.get(key, default)
    assert scratch_folder(session) == "hdfs://lake/warehouse/_scratch/panelloom-app"


def test_partitioned_marts_keep_their_column_order(spark):
    schema = f"loom_{uuid.uuid4().hex}"
    tables.create_schema(spark, schema)
    df = spark.createDataFrame([(1, date(2020, 3, 31), "x"), (2, date(2020, 6, 30), "y")], "a int, quarter_date date, b string")
    for _ in range(2):
        assert tables.replace_partitioned(df, f"{schema}.t", "quarter_date") == 2
    assert spark.table(f"{schema}.t").columns == ["a", "quarter_date", "b"]
    assert sorted(map(tuple, spark.table(f"{schema}.t").collect())) == sorted(map(tuple, df.collect()))


def ranked(df, value, descending):
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    window = Window.partitionBy("g").orderBy(order)
    plain = df.withColumns({"r": F.rank().over(window).cast("bigint"), "p": F.percent_rank().over(window), "n": F.count("*").over(Window.partitionBy("g"))})
    own = with_rankings(df, [Ranking(("g",), value, descending, rank="r", percent_rank="p", peers="n")])
    key = lambda rows: sorted(map(repr, rows))
    return key(own.select(plain.columns).collect()), key(plain.collect())


@pytest.mark.parametrize("descending", [True, False])
def test_ranks_of_any_ordered_type(spark, descending):
    nan, inf = math.nan, math.inf
    data = [
        ("a", 1.0, date(2020, 1, 1), "x", -(2**63)), ("a", nan, None, "y", 2**63 - 1), ("a", -inf, date(2021, 1, 1), None, 0),
        ("a", inf, date(2020, 1, 1), "x", None), ("a", None, date(1900, 1, 1), "", -(2**63)), (None, 2.0, None, "z", 5), (None, nan, None, "z", 5),
    ]
    df = spark.createDataFrame(data, "g string, v double, d date, s string, n0 bigint")
    for value in ("v", "d", "s", "n0"):
        own, plain = ranked(df, value, descending)
        assert own == plain


def test_rankings_of_several_types_at_once(spark):
    df = spark.createDataFrame([("a", 1.0, date(2020, 1, 1)), ("a", 2.0, None), ("a", None, date(2020, 1, 2))], "g string, v double, d date")
    both = with_rankings(df, [Ranking(("g",), "v", True, rank="by_value"), Ranking(("g",), "d", rank="by_date")])
    assert sorted((r.by_value, r.by_date) for r in both.collect()) == [(1, 3), (2, 1), (3, 2)]


def test_median_of_infinite_values(spark):
    df = spark.createDataFrame([(math.inf, 1.0), (math.inf, 3.0)], "a double, b double")
    assert tuple(exact_medians(df, {"a": "x", "b": "y"}).first()) == (math.inf, 2.0)


@pytest.mark.parametrize(
    "text",
    [
        "select reflect('java.lang.System', 'getProperty', 'java.version')",
        "select `java_method`('java.lang.System', 'currentTimeMillis')",
        "select try_reflect ('java.lang.System', 'nanoTime')",
        "select * from text.`/etc/hostname`",
        "select * from secret",
        "select (select max(id) from secret) as m",
        "with n as (select * from secret) select * from n",
        "select * from range(5)",
        "select * from member_flow where abn in (select id from secret)",
        "select * from member_flow join mart.other",
    ],
)
def test_questions_read_the_marts_alone(spark, text):
    spark.range(3).createOrReplaceTempView("secret")
    spark.createDataFrame([(1,)], "abn int").createOrReplaceTempView("member_flow")
    with pytest.raises(selects.Refused):
        selects.answer(spark, text)


def test_questions_over_the_marts_run(spark):
    spark.createDataFrame([(1,), (2,)], "abn int").createOrReplaceTempView("member_flow")
    sql = "with n as (select abn from member_flow) select n.abn, (select count(*) from n) as c from n where abn in (select abn from Member_Flow) order by 1"
    found = selects.answer(spark, sql)
    assert found.results == [{"abn": 1, "c": 2}, {"abn": 2, "c": 2}]
    rows = selects.answer_frame(spark, found, "abn int, c bigint").collect()
    assert [(r.abn, r.column_names, r.row_count, r.truncated) for r in rows] == [(1, "abn,c", 2, False), (2, "abn,c", 2, False)]


def test_catalog_off_schemas_runs_no_job(spark):
    schema = spark.createDataFrame([], "a int, b decimal(10,6)").schema
    assert selects.catalog_columns({"t": schema}) == [("t", "a", "int", 1), ("t", "b", "decimal(10,6)", 2)]


def test_preview_shows_rows_with_their_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert [r.row for r in preview(df, 3).collect()] == ['{"a":1,"b":null}']
    assert set(marts.MARTS) == {"fund_performance", "fee_vs_return", "member_flow"}
