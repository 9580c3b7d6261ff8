"""Landed sheet rows: choosing sheets, headers, names, tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom import fixed_values as fixed
from panelloom.catalogue import query
from panelloom.functions.names import rename_all, single_spaced, snake_case, snake_case_name, strip_space
from panelloom.operators.frames import drop_empty_rows, drop_unnamed, project_present, rename_present, shape
from panelloom.plans import merge
from panelloom.sources import sheets
from panelloom.standins.documents import CELLS_SQL, document_cells, language_sheets
from panelloom.standins.panel import PANEL_SQL, panel
from panelloom.standins.tables import table
from panelloom.standins.workbooks import POINTS_SQL, landed_customers, landed_products

# The languages whose documents stand for sheets without data.
NO_DATA_LANGUAGES = ["en", "de"]

SPACE = r"\p{Z}\t-\r\x1c-\x1f\x{85}"


@query(
    "sheet_select",
    """with data as (select source as file, doc_id, lang from documents where lang not in ('en', 'de'))
    select f.file, (select arg_min(' ' || upper(lang) || ' ', doc_id) from data d where d.file = f.file) as sheet
    from (select distinct source as file from documents) f""",
)
def sheet_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.chosen_sheets(language_sheets(spark, sf_dir), NO_DATA_LANGUAGES)


@query(
    "header_row",
    f"""with {CELLS_SQL}
    select file, sheet, cast(coalesce(min(row_idx) filter (
        where row_idx < 15 and len(list_filter(cells, lambda c: c is not null)) > 3), 0) as integer) as header_row
    from cells group by file, sheet""",
)
def header_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.header_rows(document_cells(spark, sf_dir))


@query(
    "header_names",
    f"""with {CELLS_SQL},
    headers as (
      select file, sheet, coalesce(min(row_idx) filter (
          where row_idx < 15 and len(list_filter(cells, lambda c: c is not null)) > 3), 0) as header_row
      from cells group by file, sheet
    ),
    widths as (select file, sheet, max(len(cells)) as width from cells group by file, sheet),
    given as (
      select file, sheet, cells, unnest(range(width)) as pos
      from cells join headers using (file, sheet) join widths using (file, sheet) where row_idx = header_row
    ),
    named as (select file, sheet, pos, coalesce(cells[pos + 1], 'Unnamed: ' || pos) as name from given)
    select file, sheet, cast(pos as integer) as pos,
           case when row_number() over w = 1 then name else name || '.' || (row_number() over w - 1) end as name
    from named window w as (partition by file, sheet, name order by pos)""",
)
def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = document_cells(spark, sf_dir)
    names = sheets.header_names(cells, sheets.header_rows(cells))
    return names.select("file", "sheet", F.posexplode("names").alias("pos", "name"))


@query(
    "snake_case",
    rf"""select doc_id, lower(regexp_replace(regexp_replace(
        regexp_replace(text, '[^\p{{L}}\p{{N}}_{SPACE}]', '', 'g'),
        '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), '[{SPACE}]+', '_', 'g')) as name
    from documents""",
)
def snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", snake_case(F.col("text")).alias("name"))


@query(
    "norm_ws",
    rf"""select doc_id, regexp_replace(regexp_replace(text, '[{SPACE}]+', ' ', 'g'), '^ | $', '', 'g') as name
    from documents""",
)
def norm_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", single_spaced(F.col("text")).alias("name"))


@query(
    "sheet_cells",
    f"""with {CELLS_SQL},
    widths as (select file, sheet, max(len(cells)) as width from cells group by file, sheet),
    places as (
      select file, sheet, cells, unnest(range(width)) as pos from cells join widths using (file, sheet) where row_idx = 0
    ),
    heads as (
      select file, sheet, pos, coalesce(cells[pos + 1], 'Unnamed: ' || pos) as name from places
    ),
    named as (
      select file, sheet, pos,
             case when row_number() over w = 1 then name else name || '.' || (row_number() over w - 1) end as name
      from heads window w as (partition by file, sheet, name order by pos)
    ),
    body as (
      select file, sheet, row_idx, unnest(cells) as value, generate_subscripts(cells, 1) - 1 as pos
      from cells where row_idx > 0
    )
    select file, sheet, cast(row_idx as integer) as row_idx, cast(pos as integer) as pos, name, value
    from body left join named using (file, sheet, pos) where value is not null""",
)
def sheet_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word below a document's first line, under the word that heads it or its position."""
    cells = document_cells(spark, sf_dir)
    found = sheets.long_cells(cells, sheets.header_names(cells, 0))
    return found.where(F.col("value").isNotNull())


@query(
    "sheet_to_table",
    f"""with {POINTS_SQL}
    select strftime(quarter_date, '%Y-%m-%d') || ' 00:00:00' as "Period*", ' ' || cast(p.abn as varchar) as "Fund ABN",
           product_name as "MySuper product name", '0.' || lpad(cast(total_fee_pct as varchar), 6, '0') || '5'
             as "Total fees and costs (rep member)"
    from points p join funds f on f.abn = p.abn""",
)
def sheet_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet below its fixed header offset, the units row left out."""
    rows = landed_products(spark, sf_dir).where(F.col("sheet") == fixed.RETURNS_SHEET)
    names = sheets.clean_names(sheets.header_names(rows, fixed.RETURNS_HEADER))
    wanted = ["Period*", "Fund ABN", "MySuper product name", "Total fees and costs (rep member)"]
    return sheets.sheet_table(rows, names, wanted, units_row=True)


@query(
    "returns_sheet",
    f"""with {POINTS_SQL}
    select quarter_date as quarter_year, cast(p.abn as varchar) as abn, product_name, fund_name
    from points p join funds f on f.abn = p.abn""",
)
def returns_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge.returns_and_fees(landed_products(spark, sf_dir))
    return project_present(rows, ["quarter_year", "abn", "product_name", "fund_name"]).withColumn(
        "fund_name", strip_space(F.col("fund_name"))
    )


@query(
    "generic_load",
    """select cast(c_custkey as varchar) as "Customer key", cast(null as varchar) as "Unnamed: 1",
      cast(c_acctbal as varchar) as "Account balance (AUD)", c_mktsegment as "Market segment",
      lower(c_mktsegment) as "Market segment.1" from customer""",
)
def generic_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.first_sheet_table(landed_customers(spark, sf_dir))


@query(
    "drop_unnamed",
    """select cast(c_custkey as varchar) as customer_key, cast(c_acctbal as varchar) as account_balance_aud,
      c_mktsegment as market_segment, lower(c_mktsegment) as market_segment1 from customer""",
)
def without_unnamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in snake case, then columns without a name of their own go."""
    return drop_unnamed(rename_all(sheets.first_sheet_table(landed_customers(spark, sf_dir)), snake_case_name))


@query(
    "detected_table",
    """select 'customers_' || (c_custkey // 1000000) as file, cast(c_custkey as varchar) as customer_key,
      cast(c_acctbal as varchar) as account_balance_aud, c_mktsegment as market_segment,
      lower(c_mktsegment) as market_segment1 from customer""",
)
def detected_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.detected_table(landed_customers(spark, sf_dir))


@query(
    "drop_all_null",
    f"""with {PANEL_SQL} select total_fee_pct, return_1yr from panel
    where total_fee_pct is not null or return_1yr is not null""",
)
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty_rows(panel(spark, sf_dir).select("total_fee_pct", "return_1yr"))


@query("rename_map", "select s_suppkey as abn, s_name as fund_name, s_nationkey, s_acctbal from supplier")
def rename_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"s_suppkey": "abn", "s_name": "fund_name", "Fund type": "fund_type"}
    return rename_present(table(spark, sf_dir, "supplier"), mapping)


@query("project_lenient", "select l_shipdate::date as l_shipdate, l_suppkey, l_returnflag from lineitem")
def project_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = project_present(table(spark, sf_dir, "lineitem"), ["l_shipdate", "abn", "l_suppkey", "l_returnflag"])
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


SHAPES = {"lineitem": 11, "orders": 6, "customer": 5, "documents": 5, "events": 6}


@query(
    "shape_report",
    " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, {n}::bigint as n_columns from {name}" for name, n in SHAPES.items()
    ),
)
def shape_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [shape(table(spark, sf_dir, name), name) for name in SHAPES])
