"""Three sheets of the product workbooks merged to one raw panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom import fixed_values as fixed
from panelloom.functions.values import date_key, text_key
from panelloom.operators.frames import drop_null_key, project_present, rename_present
from panelloom.sources.sheets import (
    clean_names,
    described,
    require_names,
    require_sheets,
    require_width,
    sheet_names,
    sheet_table,
)

KEYS = ["quarter_year", "abn"]
AMOUNT_TYPE = "decimal(28,6)"
HEADERS = {
    fixed.RETURNS_SHEET: fixed.RETURNS_HEADER,
    fixed.ASSETS_SHEET: fixed.ASSETS_HEADER,
    fixed.MEMBERS_SHEET: fixed.MEMBERS_HEADER,
}
TOTALS = {fixed.ASSETS_SHEET: fixed.ASSETS_COLUMNS, fixed.MEMBERS_SHEET: fixed.MEMBERS_COLUMNS}


def keyed(column: str) -> Column:
    """A cell of a row that has an identifier; notes below a table have none."""
    return F.when(F.col("abn").isNotNull(), F.col(column))


def typed_keys(df: DataFrame, strict: bool = True) -> DataFrame:
    """Period as date, identifier as trimmed text; the same keys on every sheet.

    Rows without an identifier go. Their periods may hold any text, so those
    are not cast. The empty default is never reached; it tells the optimizer
    that the key needs no null check, which would repeat the whole expression.
    """
    period = date_key(keyed("quarter_year"), strict)
    identifier = F.coalesce(text_key(F.col("abn")), F.lit(""))
    return drop_null_key(df, "abn").withColumns({"quarter_year": period, "abn": identifier})


def _by_sheet(values: dict[str, object]) -> Column:
    """The value of a row's sheet, null on other sheets."""
    found = F.lit(None)
    for sheet, value in values.items():
        found = F.when(F.col("sheet") == sheet, F.lit(value)).otherwise(found)
    return found


def role_names(cells: DataFrame, wanted: Sequence[str], sheets: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """The column names of the ``wanted`` sheets, written, and all names of returns sheets in their order.

    Every file must have each of the sheets, reaching down to its header, and
    totals must have all their columns. One query over the names tells all of
    that; what is wrong is looked up only where something is.
    """
    sheets = described(cells) if sheets is None else sheets
    header = _by_sheet({sheet: HEADERS[sheet] for sheet in wanted}).cast("int")
    names = clean_names(sheet_names(sheets, header, every=True))
    # one row a name, and one a sheet with its number of names under the name null
    size = F.struct(F.lit(None).cast("string").alias("name"), F.size("names").alias("pos"))
    entries = F.concat(F.transform("names", lambda n, i: F.struct(n.alias("name"), i.alias("pos"))), F.array(size))
    one = names.where(F.col("header_row").isNotNull()).select("sheet", F.explode(entries).alias("entry"))
    one = one.select("sheet", "entry.name", "entry.pos")
    files = names.agg(F.count_distinct("file").alias("n")).withColumn("sheet", F.lit(None).cast("string"))
    found = one.groupBy("sheet", "name").agg(F.count("*").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    rows = found.unionByName(files, allowMissingColumns=True).collect()
    count = {(r["sheet"], r["name"]): r["n"] for r in rows}
    n_files = count.get((None, None), 0)
    if any(count.get((sheet, None), 0) < n_files for sheet in wanted):
        require_sheets(cells, wanted)
        raise ValueError(f"a sheet among {sorted(wanted)} ends above its header")
    for sheet in wanted:
        if sheet in TOTALS and any(count.get((sheet, name), 0) < n_files for name in TOTALS[sheet]):
            require_names(names.where(F.col("sheet") == sheet), list(TOTALS[sheet]))
    require_width(names, max((r["high"] for r in rows if r["sheet"] and r["name"] is None), default=0))
    returns = [r for r in rows if r["sheet"] == fixed.RETURNS_SHEET and r["name"] is not None]
    return names, [r["name"] for r in sorted(returns, key=lambda r: (r["low"], r["name"]))]


def _products(cells: DataFrame, names: DataFrame, known: list[str], strict: bool) -> DataFrame:
    rows = cells.where(F.col("sheet") == fixed.RETURNS_SHEET)
    present = [name for name in known if name in fixed.RETURNS_COLUMNS]
    table = rename_present(sheet_table(rows, names, present, units_row=True), fixed.RETURNS_COLUMNS)
    return typed_keys(project_present(table, list(fixed.RETURNS_COLUMNS.values())), strict)


def _totals(cells: DataFrame, names: DataFrame, wanted: Sequence[str], strict: bool) -> DataFrame:
    """The wanted stage-level sheets summed to fund and quarter, an amount a sheet, in one read of the cells.

    A sheet's amount is null for a key that only another sheet has, and 0 for
    one whose amounts are all null.
    """
    looked_up = lambda column: _by_sheet({s: h for s in wanted for h, c in TOTALS[s].items() if c == column})
    amounts = {s: next(c for c in TOTALS[s].values() if c not in KEYS) for s in wanted}
    header = _by_sheet({s: h for s in wanted for h, c in TOTALS[s].items() if c == amounts[s]})
    columns = {"quarter_year": looked_up("quarter_year"), "abn": looked_up("abn"), "amount": header}
    table = sheet_table(cells.where(F.col("sheet").isin(list(wanted))), names, columns, keep=["sheet"])
    number = keyed("amount").cast(AMOUNT_TYPE) if strict else F.col("amount").try_cast(AMOUNT_TYPE)
    typed = typed_keys(drop_null_key(table.withColumn("amount", number), *KEYS), strict)
    if strict:
        # As for the identifier: a period that is there is a date here, or raised.
        typed = typed.withColumn("quarter_year", F.coalesce("quarter_year", F.lit("0001-01-01").cast("date")))

    def total(sheet: str) -> Column:
        own = F.col("sheet") == sheet
        some = F.count_if(own) > 0
        return F.when(some, F.coalesce(F.sum(F.when(own, F.col("amount"))), F.lit(0))).alias(amounts[sheet])

    return drop_null_key(typed, *KEYS).groupBy(*KEYS).agg(*[total(s) for s in wanted])


def returns_and_fees(cells: DataFrame, strict: bool = True) -> DataFrame:
    """Product rows; columns no sheet has are left out."""
    rows = cells.where(F.col("sheet") == fixed.RETURNS_SHEET)
    return _products(rows, *role_names(rows, [fixed.RETURNS_SHEET]), strict)


def assets(cells: DataFrame, strict: bool = True) -> DataFrame:
    """The assets sheet summed to fund and quarter; all its columns must exist."""
    return _one_total(cells, fixed.ASSETS_SHEET, strict)


def members(cells: DataFrame, strict: bool = True) -> DataFrame:
    """The members sheet summed to fund and quarter; all its columns must exist."""
    return _one_total(cells, fixed.MEMBERS_SHEET, strict)


def _one_total(cells: DataFrame, sheet: str, strict: bool) -> DataFrame:
    rows = cells.where(F.col("sheet") == sheet)
    names, _ = role_names(rows, [sheet])
    return _totals(rows, names, [sheet], strict)


def merge_sheets(cells: DataFrame, strict: bool = True, sheets: DataFrame | None = None) -> DataFrame:
    """Product rows with their fund's assets and members of the quarter.

    Both totals come from one aggregate with one row per key, so product rows
    are joined once and not multiplied. A fund missing from a sheet gets null;
    a workbook without one of the sheets raises. The join stays unhinted: the
    engine broadcasts totals that are small and splits hot keys of the product
    side. ``sheets`` are the descriptions of the cells, if there are any.
    """
    names, known = role_names(cells, list(HEADERS), sheets)
    return _products(cells, names, known, strict).join(_totals(cells, names, list(TOTALS), strict), KEYS, "left")
