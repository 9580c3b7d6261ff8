"""Workbook sheets landed as rows of text cells, turned into tables.

The input is one row per sheet row of any number of workbooks: ``file``,
``sheet``, ``sheet_pos`` (order in the workbook), ``row_idx`` (from 0) and
``cells`` (array of text, null = empty). Each step works on all sheets of all
files in one job. Cells are read twice: once for a description of each sheet,
a row with its width and leading rows, and once for the table itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.fixed_values import HEADER_MIN_FILLED, HEADER_SEARCH_ROWS, SKIP_SHEETS
from panelloom.functions.names import single_spaced, snake_case, strip_space
from panelloom.session import write_through

SHEET = ["file", "sheet"]
MAX_COLUMNS = 16_384  # what a sheet can hold


def listed_sheets(cells: DataFrame) -> DataFrame:
    """The sheets of every file, once each; the rows combine before the shuffle."""
    return cells.select("file", "sheet", "sheet_pos").distinct()


def chosen_sheets(cells: DataFrame, skip: Sequence[str] = SKIP_SHEETS) -> DataFrame:
    """Per file the first sheet, in workbook order, that is not on the skip list.

    A file with none is kept, with a null sheet.
    """
    is_data = ~F.lower(strip_space(F.col("sheet"))).isin(list(skip))
    first = F.min(F.when(is_data, F.struct("sheet_pos", "sheet"))).alias("_first")
    return listed_sheets(cells).groupBy("file").agg(first).select("file", F.col("_first.sheet").alias("sheet"))


def require_data_sheets(chosen: DataFrame) -> None:
    """Raise when a file has no data sheet, naming some of those files."""
    missing = chosen.where(F.col("sheet").isNull()).select("file")
    some = [row["file"] for row in missing.orderBy("file").limit(20).collect()]
    if some:
        raise ValueError(f"no data sheet in {missing.count()} file(s), among them {some}")


def require_sheets(cells: DataFrame, names: Sequence[str]) -> None:
    """Raise when a file lacks one of the sheets."""
    wanted = F.array(*[F.lit(n) for n in names])
    found = listed_sheets(cells).groupBy("file").agg(F.collect_set("sheet").alias("sheets"))
    lacking = found.select("file", F.array_except(wanted, F.col("sheets")).alias("lacks")).where(F.size("lacks") > 0)
    for row in lacking.orderBy("file").limit(1).collect():
        raise ValueError(f"{row['file']!r} has no sheet {row['lacks']}")


def filled(cells: Column) -> Column:
    """How many cells of a row hold something."""
    return F.size(F.filter(cells, lambda cell: cell.isNotNull()))


def header_rows(cells: DataFrame) -> DataFrame:
    """Per sheet the index of its header: the first well-filled leading row, or 0."""
    is_header = (F.col("row_idx") < HEADER_SEARCH_ROWS) & (filled(F.col("cells")) > HEADER_MIN_FILLED)
    found = F.min(F.when(is_header, F.col("row_idx")))
    return cells.groupBy(*SHEET).agg(F.coalesce(found, F.lit(0)).alias("header_row"))


def described(cells: DataFrame, leading: int = HEADER_SEARCH_ROWS, by: Sequence[str] = SHEET, checksum: bool = False) -> DataFrame:
    """One row per sheet, by one aggregate over all cells: what a reader has to know before it reads a sheet's rows.

    ``sheet_pos``, the number of its rows, the ``width`` of the widest one and
    the ``leading`` rows themselves, among which headers are found. With
    ``checksum`` also a hash that does not depend on the order of the rows.
    """
    top = F.when(F.col("row_idx") < leading, F.struct("row_idx", "cells"))
    listed = F.array_sort(F.collect_list(top)).alias("leading")
    facts = _facts()
    if checksum:
        facts.append(F.bit_xor(row_hash()).alias("checksum"))
    return cells.groupBy(*by).agg(*facts[:3], listed, *facts[3:])


def described_stored(cells: DataFrame, row: Column, leading: int = HEADER_SEARCH_ROWS, by: Sequence[str] = SHEET) -> DataFrame:
    """``described`` with a checksum over the hash ``row``, of cells that are cheap to read again.

    An aggregate that also lists rows sorts all its input once it has met some
    hundred sheets. Here numbers alone are taken from all rows, which needs no
    sort, and the leading rows come by a second read of little more than them.
    """
    facts = cells.groupBy(*by).agg(*_facts(), F.bit_xor(row).alias("checksum"))
    top = cells.where(F.col("row_idx") < leading).select(*by, F.struct("row_idx", "cells").alias("top"))
    one = facts.unionByName(top, allowMissingColumns=True).groupBy(*by)
    return one.agg(
        F.min("sheet_pos").alias("sheet_pos"),
        F.max("n_rows").alias("n_rows"),
        F.max("width").alias("width"),
        F.array_sort(F.collect_list("top")).alias("leading"),
        F.max("checksum").alias("checksum"),
    )


def _facts() -> list[Column]:
    return [F.min("sheet_pos").alias("sheet_pos"), F.count("*").alias("n_rows"), F.max(F.size("cells")).alias("width")]


def row_hash() -> Column:
    """A hash of a row's place and cells.

    Nulls do not change the hash of an array, so it takes in which cells are
    null, too. That is asked cell by cell only where a row may hold a null: a
    search for the empty text says false where there is neither.
    """
    some = F.coalesce(F.array_contains("cells", F.lit("")), F.lit(True))
    places = F.when(some, F.transform("cells", lambda cell: cell.isNull()))
    return F.xxhash64("sheet_pos", "row_idx", "cells", places)


def marked_row_hash() -> Column:
    """The hash of a row in manifests of the first kind: each cell marked, one by one."""
    marked = F.transform("cells", lambda cell: F.coalesce(F.concat(F.lit("="), cell), F.lit("")))
    return F.xxhash64("sheet_pos", "row_idx", marked)


def sheet_names(sheets: DataFrame, header: int | Column | None = None, every: bool = False) -> DataFrame:
    """Per sheet of ``described`` its ``header_row`` and the names in it, as the array ``names``.

    ``header`` is the row's index, for all sheets or as a column; without it
    the first well-filled leading row is taken, or row 0. A sheet without that
    row is left out or, with ``every``, has no header row and no names. There
    is a name for every column of the sheet's widest row. A column without a header cell is named after its position and a
    repeated name gets a running number not yet taken, so names are unique in
    a sheet.
    """
    if header is None:
        full = F.filter("leading", lambda row: filled(row["cells"]) > HEADER_MIN_FILLED)
        at = F.coalesce(F.get(full, F.lit(0))["row_idx"], F.lit(0))
    else:
        at = F.lit(header).cast("int") if isinstance(header, int) else header
    rows = sheets.select(*SHEET, "width", "leading", at.alias("header_row"))
    head = F.get(F.filter("leading", lambda row: row["row_idx"] == F.col("header_row")), F.lit(0))
    rows = rows.withColumn("head", head)
    rows = rows.withColumn("header_row", F.col("head.row_idx")) if every else rows.where(F.col("head").isNotNull())
    positions = F.when(F.col("width") > 0, F.sequence(F.lit(0), F.col("width") - 1)).otherwise(F.array().cast("array<int>"))
    cell = F.transform(positions, lambda i: F.coalesce(F.get("head.cells", i), F.concat(F.lit("Unnamed: "), i.cast("string"))))
    names = F.when(F.col("header_row").isNotNull(), cell).alias("names")
    return _with_unique_names(rows.select(*SHEET, "header_row", names))


def header_names(cells: DataFrame, header: int | DataFrame) -> DataFrame:
    """``sheet_names`` straight from cells; ``header`` is one offset for all sheets, or the result of ``header_rows``."""
    if isinstance(header, int):
        return sheet_names(described(cells, max(HEADER_SEARCH_ROWS, header + 1)), header)
    return sheet_names(described(cells).join(header, SHEET), F.col("header_row"))


def _with_unique_names(sheets: DataFrame) -> DataFrame:
    """Repeated ``names`` of a sheet get running numbers that no other name has.

    The nth repeat of a name takes the nth number free for it. A number t that
    another name ends in, the jth of those, has t - j free ones below it, so
    the nth free number is n and as many more as there are with t - j below n:
    both kinds of numbers are sorted together and counted in one pass. A
    window partition is one header row at most, and all windows share the
    sheet's exchange. Names that differ already pass as they are, in one row.
    """
    differ = F.size(F.array_distinct("names")) == F.size("names")
    sheets = sheets.withColumn("whole", F.when(differ, F.col("names")))
    apart = F.when(F.col("whole").isNull(), F.col("names"))
    one = sheets.select(*SHEET, "header_row", "whole", F.posexplode_outer(apart).alias("pos", "cell"))
    nth = F.row_number().over(Window.partitionBy(*SHEET, "cell").orderBy("pos"))
    one = one.withColumn("nth", nth - 1)
    numbered = r"^(.*)\.([1-9][0-9]{0,8})$"
    wanted = F.struct(F.col("cell").alias("base"), F.col("nth").alias("number"), F.lit(False).alias("taken"))
    ends = F.when(
        (F.col("nth") == 0) & F.col("cell").rlike(numbered),
        F.struct(
            F.regexp_extract("cell", numbered, 1).alias("base"),
            F.regexp_extract("cell", numbered, 2).cast("int").alias("number"),
            F.lit(True).alias("taken"),
        ),
    )
    both = one.select(*SHEET, "header_row", "whole", "pos", "cell", F.explode(F.array_compact(F.array(wanted, ends))).alias("n"))
    both = both.select(*SHEET, "header_row", "whole", "pos", "cell", "n.*")
    jth = F.row_number().over(Window.partitionBy(*SHEET, "base", "taken").orderBy("number"))
    both = both.withColumn("place", F.when(F.col("taken"), F.col("number") - jth).otherwise(F.col("number")))
    so_far = Window.partitionBy(*SHEET, "base").orderBy("place", "taken").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = F.col("number") + F.count_if("taken").over(so_far)
    name = F.when(F.col("number") == 0, F.col("cell")).otherwise(F.concat("cell", F.lit("."), free.cast("string")))
    listed = F.array_sort(F.collect_list(F.when(~F.col("taken") & F.col("pos").isNotNull(), F.struct("pos", "name"))))
    return (
        both.withColumn("name", name)
        .groupBy(*SHEET)
        .agg(
            F.min("header_row").alias("header_row"),
            F.coalesce(F.first("whole", ignorenulls=True), F.transform(listed, lambda x: x["name"])).alias("names"),
        )
    )


def clean_names(names: DataFrame, rule=single_spaced) -> DataFrame:
    """Apply a rule for names to every name of every sheet.

    Names that the rule makes equal are told apart by running numbers. The
    result, one row per sheet, is written once: it is read for the schema and
    again for the positions of the columns.
    """
    return write_through(_with_unique_names(names.withColumn("names", F.transform("names", rule))), "names")


def is_data(units_row: bool = False) -> Column:
    """Whether a row lies below the header, and below the units row if there is one."""
    return F.col("row_idx") >= F.col("header_row") + (2 if units_row else 1)


def below_header(cells: DataFrame, names: DataFrame, units_row: bool = False) -> DataFrame:
    """The rows below each sheet's header, with ``names`` columns joined on.

    ``names`` has one row per sheet, so rows are not multiplied, and the
    engine may split a sheet that holds a large share of them.
    """
    return cells.join(names, SHEET).where(is_data(units_row))


def long_cells(cells: DataFrame, names: DataFrame) -> DataFrame:
    """One row per cell below a header: sheet, row, position, name and value."""
    zipped = F.arrays_zip(F.col("names").alias("name"), F.col("cells").alias("value"))
    return (
        below_header(cells, names)
        .select(*SHEET, "row_idx", F.posexplode(zipped).alias("pos", "cell"))
        .select(*SHEET, "row_idx", "pos", F.col("cell")["name"].alias("name"), F.col("cell")["value"].alias("value"))
    )


def sheet_table(
    cells: DataFrame,
    names: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    keep: Sequence[str] = (),
    units_row: bool = False,
) -> DataFrame:
    """The rows below the header as a table, each column found by its name.

    ``columns`` are names, or output columns with the name to look up, which
    may differ from sheet to sheet. Sheets may order their columns
    differently. A column a sheet does not have is null there. Positions are
    resolved once per sheet, on the names.

    A cell is null outside the data rows, too: a strict cast that the
    optimizer moves ahead of the row filter must not meet a header text.
    """
    looked_up = columns if isinstance(columns, Mapping) else {c: F.lit(c) for c in columns}
    positions = names.select(
        *SHEET,
        "header_row",
        *[F.array_position("names", c).cast("int").alias(f"_pos_{i}") for i, c in enumerate(looked_up.values())],
    )
    cell = [
        F.when(is_data(units_row) & (F.col(f"_pos_{i}") > 0), F.get("cells", F.col(f"_pos_{i}") - 1)).alias(c)
        for i, c in enumerate(looked_up)
    ]
    return below_header(cells, positions, units_row).select(*keep, *cell)


def require_names(names: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a sheet lacks one of the columns."""
    wanted = F.array(*[F.lit(c) for c in columns])
    lacking = names.select(*SHEET, F.array_except(wanted, F.col("names")).alias("lacks")).where(F.size("lacks") > 0)
    for row in lacking.limit(1).collect():
        raise ValueError(f"sheet {row['sheet']!r} of {row['file']!r} has no column {row['lacks']}")


def require_width(names: DataFrame, widest: int) -> None:
    """Raise when ``widest`` is more names than a sheet can have, naming such a sheet."""
    if widest > MAX_COLUMNS:
        row = names.where(F.size("names") > MAX_COLUMNS).select(*SHEET).first()
        raise ValueError(f"sheet {row['sheet']!r} of {row['file']!r} has more than {MAX_COLUMNS} columns")


def distinct_names(names: DataFrame) -> list[str]:
    """All column names of the sheets, ordered by first position.

    They become a schema, so they come to the driver. No sheet may have more
    columns than a sheet can hold.
    """
    one = names.select(F.posexplode("names").alias("pos", "name"))
    found = one.groupBy("name").agg(F.min("pos").alias("pos"), F.max("pos").alias("last")).collect()
    require_width(names, max((row["last"] for row in found), default=-1) + 1)
    return [row["name"] for row in sorted(found, key=lambda row: (row["pos"], row["name"]))]


def written_descriptions(cells: DataFrame, leading: int = HEADER_SEARCH_ROWS) -> DataFrame:
    """``described``, written once: a row per sheet that headers, names and checks are then read from."""
    return write_through(described(cells, leading), "sheets")


def first_sheet_table(cells: DataFrame, sheets: DataFrame | None = None) -> DataFrame:
    """Each file's first sheet as it is, the header in its first row; ``sheets`` are its descriptions, if there are any."""
    sheets = written_descriptions(cells) if sheets is None else sheets
    first = sheets.groupBy("file").agg(F.min_by("sheet", "sheet_pos").alias("sheet"))
    names = clean_names(sheet_names(sheets.join(first, SHEET, "left_semi"), 0))
    return sheet_table(cells, names, distinct_names(names))


def detected_table(cells: DataFrame, sheets: DataFrame | None = None) -> DataFrame:
    """Each file's chosen sheet below its detected header, with tidy names.

    Rows without any value go first; then unnamed columns go, so a row filled
    only there stays, empty.
    """
    sheets = written_descriptions(cells) if sheets is None else sheets
    chosen = chosen_sheets(sheets)
    require_data_sheets(chosen)
    names = clean_names(sheet_names(sheets.join(chosen, SHEET, "left_semi")), snake_case)
    kept = [name for name in distinct_names(names) if not name.startswith("unnamed")]
    return sheet_table(cells.where(filled(F.col("cells")) > 0), names, kept, keep=["file"])
