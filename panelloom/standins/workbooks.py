"""Driver tables landed as workbooks: rows of text cells, one sheet row each.

``product_workbooks`` lays out one workbook per fund with the three sheets the
merge reads, furnished as real ones are: title rows, header texts with line
breaks, a units row, columns nobody asks for, keys written differently from
sheet to sheet. ``customer_workbook`` and ``part_workbook`` are plain sheets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom import fixed_values as fixed
from panelloom.session import write_through
from panelloom.standins.panel import funds, lines
from panelloom.standins.tables import table

CELL_COLUMNS = ["file", "sheet", "sheet_pos", "row_idx", "cells"]

SHEET_ROWS = 1_000_000

ASSETS_POS, RETURNS_POS, MEMBERS_POS = 1, 2, 3
ASSETS_LAYOUT = ["Fund ABN", "Stage", "Period*", "Total  assets"]
MEMBERS_LAYOUT = ["Period *", "Member\naccounts", "Fund ABN"]
RETURNS_LAYOUT = [
    "Period*",
    "Fund licensee",
    "Fund\nname",
    " Fund ABN",
    "MySuper product name",
    "Fund type",
    "Total fees and costs\n(rep member)",
    "Investment fees (rep member)",
    "Administration fees and costs (rep member)",
    "One-year net return (rep member) - Annualised",
    "Three year net return (rep member) -  Annualised",
    "Five year net return (rep member) - Annualised",
]


def product_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number points per fund, quarter and product; null without such lines."""
    open_line, done = F.col("status") == "O", F.col("status") == "F"
    points = lambda column, kind: F.sum(F.when(kind, F.col(column)))
    return (
        lines(spark, sf_dir)
        .groupBy("abn", "quarter_date", "product_name")
        .agg(
            points("tax", F.col("qty") > 38).alias("return_1yr"),
            points("qty", open_line).alias("return_3yr"),
            points("qty", done).alias("return_5yr"),
            points("disc", open_line).alias("investment_fee_pct"),
            points("disc", done).alias("admin_fee_pct"),
            points("disc", F.col("qty") <= 12).alias("total_fee_pct"),
            points("cents", open_line).alias("cents"),
            F.sum("qty").alias("qty"),
        )
    )


def rate_text(points: Column) -> Column:
    """Seven digits after the point, the last one a 5: six digits round up."""
    return F.concat(F.lit("0."), F.lpad(points.cast("string"), 6, "0"), F.lit("5"))


def _rows(df: DataFrame, sheet: str, pos: int, row_idx: Column, cells: list[Column]) -> DataFrame:
    return df.select(
        "file",
        F.lit(sheet).alias("sheet"),
        F.lit(pos).alias("sheet_pos"),
        row_idx.cast("int").alias("row_idx"),
        F.array(*cells).alias("cells"),
    )


def _furniture(books: DataFrame, sheet: str, pos: int, header: int, layout: list[str], units: bool = False) -> DataFrame:
    """Title rows, blank rows, the header and perhaps the units row of a sheet."""
    blank = [None] * len(layout)
    rows = [[f"{sheet} by quarter", *blank[1:]], *[blank] * (header - 1), layout]
    if units:
        rows.append([None, *["%"] * (len(layout) - 1)])
    literal = lambda cells: F.array(*[F.lit(c).cast("string") for c in cells])
    structs = [
        F.struct(
            F.lit(sheet).alias("sheet"), F.lit(pos).alias("sheet_pos"), F.lit(i).alias("row_idx"), literal(row).alias("cells")
        )
        for i, row in enumerate(rows)
    ]
    return books.select("file", F.inline(F.array(*structs)))


def product_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workbook per fund. A fund's sheet has a row per quarter and flag."""
    book = F.concat(F.lit("fund_"), F.col("abn").cast("string"))
    fund = funds(spark, sf_dir)
    points = product_points(spark, sf_dir).join(fund, "abn").withColumn("file", book)
    place = F.row_number().over(Window.partitionBy("abn").orderBy("quarter_date", "product_name"))  # a fund is a file
    points = write_through(points.withColumn("place", place), "points")
    books = fund.select(book.alias("file"))

    abn, day = F.col("abn").cast("string"), F.col("quarter_date").cast("string")
    money = F.concat(F.expr("cents div 100").cast("string"), F.lit("."), F.lpad(F.expr("cents % 100").cast("string"), 2, "0"))
    cells = {
        "Period*": F.concat(day, F.lit(" 00:00:00")),
        "Fund licensee": F.concat(F.lit("Licensee of "), F.col("fund_name")),
        "Fund\nname": F.concat(F.lit(" "), F.col("fund_name"), F.lit("  ")),
        " Fund ABN": F.concat(F.lit(" "), abn),
        "MySuper product name": F.col("product_name"),
        "Fund type": F.concat(F.lit(" "), F.initcap("fund_type")),
    }
    rates = ["total_fee_pct", "investment_fee_pct", "admin_fee_pct", "return_1yr", "return_3yr", "return_5yr"]
    returns = [*cells.values(), *[rate_text(F.col(c)) for c in rates]]
    parts = [
        _furniture(books, " Cover", 0, 1, ["Statistics"]),
        _furniture(books, fixed.ASSETS_SHEET, ASSETS_POS, fixed.ASSETS_HEADER, ASSETS_LAYOUT),
        _furniture(books, fixed.RETURNS_SHEET, RETURNS_POS, fixed.RETURNS_HEADER, RETURNS_LAYOUT, units=True),
        _furniture(books, fixed.MEMBERS_SHEET, MEMBERS_POS, fixed.MEMBERS_HEADER, MEMBERS_LAYOUT),
        _rows(
            points,
            fixed.ASSETS_SHEET,
            ASSETS_POS,
            F.col("place") + fixed.ASSETS_HEADER,
            [F.concat(abn, F.lit(".0")), F.col("product_name"), day, money],
        ),
        _rows(points, fixed.RETURNS_SHEET, RETURNS_POS, F.col("place") + fixed.RETURNS_HEADER + 1, returns),
        _rows(
            points,
            fixed.MEMBERS_SHEET,
            MEMBERS_POS,
            F.col("place") + fixed.MEMBERS_HEADER,
            [F.concat(day, F.lit(" ")), F.col("qty").cast("string"), F.concat(abn, F.lit(" "))],
        ),
    ]
    return reduce(DataFrame.unionByName, parts).select(*CELL_COLUMNS)


def plain_workbooks(df: DataFrame, file: str, key: str, header: list[str | None], cells: list[Column]) -> DataFrame:
    """Workbooks of one sheet, the header on top; ``key`` counts from 0.

    A sheet takes a million rows at most, so each million is a workbook.
    """
    book = F.concat(F.lit(file), F.lit("_"), F.floor(F.col(key) / SHEET_ROWS).cast("string"))
    filed = df.withColumn("file", book)
    top = F.array(*[F.lit(c).cast("string") for c in header])
    headers = filed.select("file").distinct().select(
        "file", F.lit("Data").alias("sheet"), F.lit(0).alias("sheet_pos"), F.lit(0).alias("row_idx"), top.alias("cells")
    )
    return headers.unionByName(_rows(filed, "Data", 0, F.col(key) % SHEET_ROWS + 1, cells))


def customer_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as plain sheets."""
    header = ["Customer\n key", None, "Account  balance (AUD)", "Market segment", "Market segment"]
    text = [F.col(c).cast("string") for c in ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")]
    blank = F.lit(None).cast("string")
    cells = [text[0], blank, text[2], text[3], F.lower(text[3])]
    return plain_workbooks(table(spark, sf_dir, "customer"), "customers", "c_custkey", header, cells)


def landed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer workbook as a written landing."""
    return write_through(customer_workbook(spark, sf_dir), "landed")


def part_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = ["Part key", "Part name", " Brand ", "Size"]
    cells = [F.col(c).cast("string") for c in ("p_partkey", "p_name", "p_brand", "p_size")]
    return plain_workbooks(table(spark, sf_dir, "part"), "parts", "p_partkey", header, cells)


def landed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product workbooks as a written landing, which the merge reads by sheet."""
    return write_through(product_workbooks(spark, sf_dir), "landed")


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run's landing: the workbooks of all three registered data sets."""
    books = {
        "product_quarterly": product_workbooks(spark, sf_dir),
        "fund_quarterly": customer_workbook(spark, sf_dir),
        "annual_bulletin": part_workbook(spark, sf_dir),
    }
    return reduce(DataFrame.unionByName, [df.withColumn("dataset", F.lit(key)) for key, df in books.items()])


POINTS_SQL = """
lines as (
  select l_suppkey as abn, cast(date_trunc('quarter', l_shipdate) as date) as quarter_date,
         l_returnflag as product_name, l_linestatus as status, cast(l_quantity as bigint) as qty,
         cast(round(l_discount * 100) as bigint) as disc, cast(round(l_tax * 100) as bigint) as tax,
         cast(round(l_extendedprice * 100) as bigint) as cents
  from lineitem
),
points as (
  select abn, quarter_date, product_name,
         cast(sum(tax) filter (where qty > 38) as bigint) as return_1yr,
         cast(sum(qty) filter (where status = 'O') as bigint) as return_3yr,
         cast(sum(qty) filter (where status = 'F') as bigint) as return_5yr,
         cast(sum(disc) filter (where status = 'O') as bigint) as investment_fee_pct,
         cast(sum(disc) filter (where status = 'F') as bigint) as admin_fee_pct,
         cast(sum(disc) filter (where qty <= 12) as bigint) as total_fee_pct,
         cast(sum(cents) filter (where status = 'O') as bigint) as cents,
         cast(sum(qty) as bigint) as qty
  from lines group by abn, quarter_date, product_name
),
fund_totals as (
  select abn, quarter_date, cast(coalesce(sum(cents), 0) as double) / 100 as net_assets_m,
         cast(sum(qty) as bigint) as member_accounts
  from points group by abn, quarter_date
),
funds as (
  select s_suppkey as abn, trim(s_name) as fund_name, lower(trim(r_name)) as fund_type
  from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
)
"""
