"""Sheets to tables: the edges of the workbooks, written out by hand."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom import fixed_values as fixed
from panelloom.functions.names import (
    rename_all,
    single_spaced,
    single_spaced_name,
    snake_case,
    snake_case_name,
    strip_space,
)
from panelloom.functions.values import date_key, growth_pct, rounded_count, rounded_count_of_double, text_key
from panelloom.operators import frames
from panelloom.plans.merge import merge_sheets
from panelloom.plans.staging import staging, unstaged
from panelloom.sources import sheets

CELLS = "file string, sheet string, sheet_pos int, row_idx int, cells array<string>"


@pytest.fixture
def book(spark):
    """Sheets given as (file, sheet, position, rows of cells)."""

    def build(*parts):
        data = [(f, s, p, i, cells) for f, s, p, lines in parts for i, cells in enumerate(lines)]
        return spark.createDataFrame(data, CELLS)

    return build


def test_first_data_sheet_and_files_without_one(book, rows):
    cells = book(
        ("a", " Cover ", 0, [["x"]]), ("a", "Data 2", 2, [["x"]]), ("a", "Data 1", 1, [["x"]]),
        ("b", "NOTES", 0, [["x"]]), ("b", "Charts\n", 1, [["x"]]),
    )
    chosen = sheets.chosen_sheets(cells)
    assert rows(chosen) == [("a", "Data 1"), ("b", None)]
    with pytest.raises(ValueError, match="among them \\['b'\\]"):
        sheets.require_data_sheets(chosen)
    sheets.require_data_sheets(chosen.where("file = 'a'"))


def test_header_is_the_first_well_filled_of_fifteen_rows(book, rows):
    sparse, full = [None, "a", "b", "c"], ["a", "b", "c", "d"]
    cells = book(
        ("f", "at14", 0, [sparse] * 14 + [full, full]),
        ("f", "at15", 1, [sparse] * 15 + [full]),
        ("f", "none", 2, [sparse] * 3),
    )
    assert rows(sheets.header_rows(cells)) == [("f", "at14", 14), ("f", "at15", 0), ("f", "none", 0)]


def test_names_of_empty_and_repeated_header_cells(book):
    cells = book(("f", "s", 0, [["a", None, "b", "a", "a", "b"], ["1"]]))
    names = sheets.header_names(cells, 0).collect()[0]
    assert names["names"] == ["a", "Unnamed: 1", "b", "a.1", "a.2", "b.1"]


NAMES = ["Fund\nname", "  Total  assets ", "One-year net return (%)", "Émile's été x", "a\x1cb", "²_‿", ""]


def test_column_names_clean_up_alike_in_cells_and_frames(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    n = F.col("n")
    for row in df.select(n, single_spaced(n).alias("s"), snake_case(n).alias("k"), strip_space(n).alias("t")).collect():
        assert row["s"] == single_spaced_name(row["n"])
        assert row["k"] == snake_case_name(row["n"])
        assert row["t"] == row["n"].strip()
    assert snake_case_name(NAMES[2]) == "oneyear_net_return"


def test_row_filled_only_in_an_unnamed_column_survives_empty(book, rows):
    cells = book(("f", "Data", 0, [["A b", None, "C", "D", "E"], ["1", None, "2", "3", "4"], [None] * 5, [None, "x", None, None, None]]))
    table = sheets.detected_table(cells)
    assert table.columns == ["file", "a_b", "c", "d", "e"]
    assert rows(table) == [("f", "1", "2", "3", "4"), ("f", None, None, None, None)]


def test_sheets_with_columns_in_different_order_make_one_table(book, rows):
    cells = book(("f", "s", 0, [["a", "b"], ["1", "2"]]), ("g", "s", 0, [["b", "c", "a"], ["4", "5", "3"], ["6"]]))
    assert rows(sheets.first_sheet_table(cells)) == [("1", "2", None), ("3", "4", "5"), (None, "6", None)]


def test_frame_steps(spark, rows):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b int, unnamed_2 string")
    assert rows(frames.drop_empty_rows(df, ["a", "b"]), "unnamed_2") == [("x",)]
    assert frames.drop_unnamed(df).columns == ["a", "b"]
    assert frames.rename_present(df, {"a": "A", "zzz": "Z"}).columns == ["A", "b", "unnamed_2"]
    assert frames.project_present(df, ["b", "nope", "a"]).columns == ["b", "a"]
    assert rows(frames.shape(df, "t")) == [("t", 2, 3)]
    assert rename_all(df, str.upper).columns == ["A", "B", "UNNAMED_2"]
    summed = frames.sum_per_key(df.withColumn("k", F.lit("k")), ["k"], "b")
    assert rows(summed) == [("k", 0)]


KEYS = {
    "51234567890": "51234567890", "51234567890.0": "51234567890", "5.123456789E10": "51234567890", " 17\n": "17",
    "0012": "0012", "abc": "abc", "1.5": "1.5", "": "", "nan": "nan",
}


def test_one_key_however_it_was_written(spark):
    df = spark.createDataFrame(list(KEYS.items()), "raw string, key string")
    assert df.where(text_key(F.col("raw")) != F.col("key")).collect() == []
    numbers = spark.createDataFrame([(51234567890.0, 51234567890)], "d double, n bigint")
    assert numbers.select(text_key(F.col("d")), text_key(F.col("n"))).collect()[0] == ("51234567890", "51234567890")


def test_dates_strict_and_lenient(spark):
    df = spark.createDataFrame([("2020-09-30 00:00:00",), (" 2020-09-30",), (None,)], "d string")
    assert [r[0] for r in df.select(date_key(F.col("d"))).collect()] == [date(2020, 9, 30)] * 2 + [None]
    bad = spark.createDataFrame([("Sep 2020",)], "d string")
    assert bad.select(date_key(F.col("d"), strict=False)).collect()[0][0] is None
    with pytest.raises(PySparkException):
        bad.select(date_key(F.col("d"))).collect()


def test_rounding_to_whole_numbers(spark):
    df = spark.createDataFrame([("2.5", 2.5), ("3.5", 3.5), ("2.7", 2.7), ("-2.5", -2.5)], "t string, d double")
    found = df.select(rounded_count(F.col("t")), rounded_count_of_double(F.col("d"))).collect()
    assert [tuple(r) for r in found] == [(3, 2), (4, 4), (3, 3), (-3, -2)]


def test_growth(spark):
    df = spark.createDataFrame([(110, 100), (5, 0), (None, 3), (20201, 20000), (-50, 100)], "now bigint, before bigint")
    found = [r[0] for r in df.select(growth_pct(F.col("now"), F.col("before"))).collect()]
    assert found == [10.0, None, None, 1.01, -150.0]


RETURNS = list(fixed.RETURNS_COLUMNS)
ASSETS = list(fixed.ASSETS_COLUMNS)
MEMBERS = list(fixed.MEMBERS_COLUMNS)


def returns_row(period, product, name, abn, kind="Retail", r1="0.05", r3="0.06", r5="0.07", inv="0.001", adm="0.002", fee="0.003"):
    return [period, product, name, abn, kind, r1, r3, r5, inv, adm, fee]


@pytest.fixture
def fund_book(book):
    """A workbook with every trap at once."""
    blank = [None] * len(RETURNS)
    return book(
        ("w", fixed.RETURNS_SHEET, 2, [
            ["Title", *blank[1:]], blank, blank, blank, RETURNS, ["", *["%"] * 10],
            returns_row("2020-09-30 00:00:00", "A1", " Fund A ", "51 "),
            returns_row("2020-09-30 00:00:00", "A2", "Fund A", "51", kind=" Public Sector ", fee=None),
            returns_row("2020-09-30 00:00:00", "B1", "Fund B", "62.0"),
            returns_row("2020-12-31 00:00:00", "A1", "Fund A", "51"),
            returns_row(None, "A1", "Fund A", "51"),
            returns_row("2020-09-30", "N", None, "70"),
            ["* a note below the table, in the period's column", *blank[1:]],
        ]),
        ("w", fixed.ASSETS_SHEET, 1, [
            ["Title", None, None], [None] * 3, [None] * 3, ASSETS,
            ["2020-09-30", "51", "10.25"], ["2020-09-30", "51.0", "0.50"], ["2020-12-31", "51", None], ["2020-09-30", None, "999"],
        ]),
        ("w", fixed.MEMBERS_SHEET, 3, [
            ["Title", None, None], [None] * 3, MEMBERS,
            ["2020-09-30 00:00:00", "51", "100"], ["2020-09-30 00:00:00", "5.1E1", "20.5"], ["2020-09-30", "62", "7"],
            ["note", None, None],
        ]),
    )


def test_merge_and_staging(fund_book, rows):
    raw = merge_sheets(fund_book)
    assert raw.count() == 6
    staged = staging(raw)
    found = rows(staged, "abn", "product_name", "quarter_date", "net_assets_m", "member_accounts")
    q3, q4 = date(2020, 9, 30), date(2020, 12, 31)
    assert found == [
        ("51", "A1", q3, Decimal("10.75"), 121),
        ("51", "A1", q4, Decimal("0.00"), None),
        ("51", "A2", q3, Decimal("10.75"), 121),
        ("62", "B1", q3, None, 7),
    ]
    assert {r["fund_name"] for r in staged.collect()} == {"Fund A", "Fund B"}
    assert {r["fund_type"] for r in staged.collect()} == {"retail", "public sector"}
    types = dict(staged.dtypes)
    assert (types["return_5yr"], types["net_assets_m"], types["member_accounts"]) == ("decimal(10,6)", "decimal(18,2)", "bigint")


def test_missing_column_is_lenient_for_returns_and_an_error_for_totals(fund_book):
    without = fund_book.withColumn(
        "cells", F.transform("cells", lambda c: F.when(c != "Three year net return (rep member) - Annualised", c))
    )
    assert "return_3yr" not in merge_sheets(without).columns
    broken = fund_book.withColumn("cells", F.transform("cells", lambda c: F.when(c != "Total assets", c)))
    with pytest.raises(ValueError, match="Total assets"):
        merge_sheets(broken)


def test_quarantine_finds_what_lenient_staging_loses(fund_book, rows):
    raw = merge_sheets(fund_book).withColumn("return_1yr", F.when(F.col("abn") == "62", "n/a").otherwise(F.col("return_1yr")))
    assert rows(unstaged(raw), "abn", "return_1yr") == [("62", "n/a")]
    lenient = staging(raw, strict=False)
    assert rows(lenient.where("abn = '62'"), "return_1yr") == [(None,)]
    with pytest.raises(PySparkException):
        staging(raw).collect()


def test_unreadable_period_raises_or_is_null(fund_book):
    broken = fund_book.withColumn("cells", F.transform("cells", lambda c: F.when(c == "2020-12-31 00:00:00", "Q4").otherwise(c)))
    with pytest.raises(PySparkException):
        merge_sheets(broken).collect()
    assert merge_sheets(broken, strict=False).where("quarter_year is null").count() == 2
