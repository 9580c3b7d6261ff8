"""One description per sheet: few jobs, two reads of the cells, names numbered in one pass."""

from __future__ import annotations

import time

import pytest

from panelloom import fixed_values as fixed
from panelloom.plans.merge import merge_sheets, role_names
from panelloom.session import write_through
from panelloom.sources import sheets
from panelloom.standins.workbooks import landed_products

CELLS = "file string, sheet string, sheet_pos int, row_idx int, cells array<string>"
SF_DIR = "/root/testdata/sf0.001"


def numbered(names):
    """The rule in plain Python: the nth repeat takes the nth number that no other such name ends in."""
    out, seen = [], {}
    for name in names:
        n = seen[name] = seen.get(name, -1) + 1
        taken = {int(o[len(name) + 1 :]) for o in names if o.startswith(f"{name}.") and o[len(name) + 1 :].isdigit() and o[len(name) + 1] != "0"}
        free = (k for k in range(1, 10**6) if k not in taken)
        out.append(name if n == 0 else f"{name}.{[next(free) for _ in range(n)][-1]}")
    return out


@pytest.mark.parametrize(
    "names",
    [
        ["a", "a", "a", "a.1", "a.3", "a.3", "b"],
        ["a.1", "a.1", "a", "a", "a.1.1", "a.2"],
        ["x", "x.10", "x.01", "x.2", *["x"] * 12],
        ["a.b", "a.b", "a.b.1", ".1", "", ""],
        ["one", "two"],
    ],
)
def test_running_numbers(spark, names):
    cells = spark.createDataFrame([("f", "s", 0, 0, names), ("g", "s", 0, 0, ["p", "p"]), ("g", "t", 1, 0, ["q", "r"])], CELLS)
    got = {(r["file"], r["sheet"]): r["names"] for r in sheets.header_names(cells, 0).collect()}
    assert got == {("f", "s"): numbered(names), ("g", "s"): ["p", "p.1"], ("g", "t"): ["q", "r"]}


def test_thousands_of_equal_names_take_one_pass(spark):
    names = ["n"] * 8_000 + [f"n.{k}" for k in range(1, 16_001, 2)]
    cells = spark.createDataFrame([("f", "s", 0, 0, names)], CELLS)
    found = sheets.header_names(cells, 0)
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString().split("n_rows")[0].lower()
    start = time.time()
    (row,) = found.collect()
    assert row["names"][:3] == ["n", "n.2", "n.4"] and len(set(row["names"])) == 16_000 and time.time() - start < 30


def test_merge_takes_few_jobs_and_two_reads(spark):
    cells, context = landed_products(spark, SF_DIR), spark.sparkContext
    context.setJobGroup("merge", "merge")
    try:
        merged = merge_sheets(cells)
        assert len(context.statusTracker().getJobIdsForGroup("merge")) < 10
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.splitlines() if "FileScan" in line and "cells" in line]
    assert len(reads) == 2 and all("PushedFilters" in line and "sheet" in line for line in reads)


def test_sheets_described_beforehand_are_not_read_for_names(spark):
    cells = landed_products(spark, SF_DIR)
    ready = write_through(sheets.described(cells), "sheets")
    names, known = role_names(None, [fixed.RETURNS_SHEET], ready)  # the cells are not looked at
    assert set(fixed.RETURNS_COLUMNS) <= set(known)
    assert merge_sheets(cells, sheets=ready).count() == merge_sheets(cells).count()


def test_a_sheet_that_ends_above_its_header_raises(spark):
    rows = [("f", s, k, i, ["x"]) for k, s in enumerate([fixed.RETURNS_SHEET, fixed.ASSETS_SHEET, fixed.MEMBERS_SHEET]) for i in range(2)]
    with pytest.raises(ValueError, match="ends above its header"):
        merge_sheets(spark.createDataFrame(rows, CELLS))


def test_description(spark):
    rows = [("f", "s", 3, i, ["a"] * (i % 4)) for i in range(40)]
    (one,) = sheets.described(spark.createDataFrame(rows, CELLS).repartition(6), checksum=True).collect()
    assert (one["sheet_pos"], one["n_rows"], one["width"], [r["row_idx"] for r in one["leading"]]) == (3, 40, 3, list(range(15)))
    changed = rows[:-1] + [("f", "s", 3, 39, ["a", None, "a"])]
    (other,) = sheets.described(spark.createDataFrame(changed, CELLS), checksum=True).collect()
    (same,) = sheets.described(spark.createDataFrame(rows[::-1], CELLS), checksum=True).collect()
    assert one["checksum"] == same["checksum"] != other["checksum"]
