"""Raw panel to staging: merge, keys, sums, typing, audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.catalogue import query
from panelloom.functions.values import date_key, rounded_count_of_double, text_key
from panelloom.operators.flow import entity_grain
from panelloom.operators.frames import drop_null_key, rename_present, sum_per_key, with_audit
from panelloom.plans import merge, staging
from panelloom.standins.panel import PANEL_SQL, panel
from panelloom.standins.tables import table
from panelloom.standins.workbooks import POINTS_SQL, landed_products

RATES = ["return_1yr", "return_3yr", "return_5yr", "investment_fee_pct", "admin_fee_pct", "total_fee_pct"]
RATE_TEXT_SQL = ", ".join(f"'0.' || lpad(cast({c} as varchar), 6, '0') || '5' as {c}" for c in RATES)
RATE_SQL = ", ".join(f"cast({c} + 1 as double) / 1000000 as {c}" for c in RATES)
LOADED_AT, RUN_DATE = "2026-01-05 22:00:00", "2026-01-05"


@query("scan_parquet", "select * from supplier")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier")


@query(
    "merge_sheets",
    f"""with {POINTS_SQL}
    select p.quarter_date as quarter_year, cast(p.abn as varchar) as abn, product_name, fund_name, fund_type,
           {RATE_TEXT_SQL}, net_assets_m, member_accounts
    from points p join funds f on f.abn = p.abn
    left join fund_totals t on t.abn = p.abn and t.quarter_date = p.quarter_date""",
)
def merge_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.merge_sheets(landed_products(spark, sf_dir))
    return merged.withColumns(
        {
            "fund_name": F.trim("fund_name"),
            "fund_type": F.lower(F.trim("fund_type")),
            "net_assets_m": F.col("net_assets_m").cast("double"),
            "member_accounts": F.col("member_accounts").cast("bigint"),
        }
    )


@query(
    "staging",
    f"""with {POINTS_SQL}
    select fund_name, cast(p.abn as varchar) as abn, product_name, p.quarter_date, {RATE_SQL},
           net_assets_m, member_accounts, fund_type
    from points p join funds f on f.abn = p.abn
    left join fund_totals t on t.abn = p.abn and t.quarter_date = p.quarter_date""",
)
def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging.staging(merge.merge_sheets(landed_products(spark, sf_dir)))
    rows.createOrReplaceTempView("staging")
    return spark.table("staging").withColumns({c: F.col(c).cast("double") for c in [*RATES, "net_assets_m"]})


@query(
    "fund_grain_sum",
    f"""with {POINTS_SQL}
    select quarter_date as quarter_year, cast(abn as varchar) as abn,
           cast(coalesce(sum(cents), 0) as double) / 100 as net_assets_m
    from points group by all""",
)
def fund_grain_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = merge.assets(landed_products(spark, sf_dir))
    return totals.withColumn("net_assets_m", F.col("net_assets_m").cast("double"))


@query(
    "sum_per_key",
    """select l_suppkey, l_shipdate, coalesce(cast(sum(qty) as bigint), 0) as qty
    from (select l_suppkey, cast(l_shipdate as date) as l_shipdate,
                 case when l_linestatus = 'O' then cast(l_quantity as bigint) end as qty from lineitem)
    group by l_suppkey, l_shipdate""",
)
def sum_with_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open quantity per supplier and day; 0 where a day has no open line."""
    open_qty = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint"))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date"), open_qty.alias("qty"))
    return sum_per_key(rows, ["l_suppkey", "l_shipdate"], "qty")


@query(
    "fund_grain",
    f"with {PANEL_SQL} select distinct abn, quarter_date, member_accounts, net_assets_m, fund_name, fund_type from panel",
)
def fund_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = ["member_accounts", "net_assets_m"]
    return entity_grain(panel(spark, sf_dir), "abn", "quarter_date", totals, ["fund_name", "fund_type"])


@query(
    "drop_null_key",
    """select l_orderkey, l_linenumber, nullif(l_linestatus, 'O') as done_status from lineitem
    where nullif(l_linestatus, 'O') is not null""",
)
def drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.nullif(F.col("l_linestatus"), F.lit("O")).alias("done_status")
    return drop_null_key(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", done), "done_status")


@query(
    "normalize_keys",
    """select l_orderkey, l_linenumber, cast(l_suppkey as varchar) as from_number, cast(l_partkey as varchar) as from_text,
      cast(l_shipdate as date) as from_timestamp, cast(l_shipdate as date) as from_date_time_text
    from lineitem""",
)
def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same key out of ``17.0``, ``' 17 '``, a timestamp and a date-time text."""
    day = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text_key(F.col("l_suppkey").cast("double")).alias("from_number"),
        text_key(F.concat(F.lit("  "), F.col("l_partkey"), F.lit(" \n"))).alias("from_text"),
        date_key(day).alias("from_timestamp"),
        date_key(F.concat(day.cast("date").cast("string"), F.lit(" 00:00:00 "))).alias("from_date_time_text"),
    )


@query(
    "count_rounding",
    """select l_orderkey, l_linenumber, l_quantity / 2 as half_quantity,
      cast(l_quantity / 2 as bigint) as rounded from lineitem""",
)
def count_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of whole quantities to whole numbers; a plain cast would cut them."""
    half = F.col("l_quantity") / 2
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", half.alias("half_quantity"), rounded_count_of_double(half).alias("rounded")
    )


@query(
    "audit_columns",
    f"""select o_orderkey, o_orderstatus, '{LOADED_AT}' as loaded_at, date '{RUN_DATE}' as run_date from orders""",
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = with_audit(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), LOADED_AT, RUN_DATE)
    text = F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss")
    return rename_present(loaded.withColumn("_loaded_at", text), {"_loaded_at": "loaded_at", "_run_date": "run_date"})


# Orders as a raw panel of texts, among them numbers too large for their type, words in place of numbers and of dates,
# and rows without a fund name.
_ORDER_CENTS = "cast(round(o_totalprice * 100) as bigint)"
_ORDER_PANEL = {
    "abn": "cast(o_orderkey as varchar(20))",
    "fund_name": "nullif(o_orderstatus, 'P')",
    "product_name": "cast(o_custkey as varchar(20))",
    "quarter_year": "case when o_orderpriority like '5%' then o_orderpriority"
    " else cast(cast(o_orderdate as date) as varchar(10)) || ' 00:00:00' end",
    "return_1yr": f"cast(cast(floor({_ORDER_CENTS} / 100) as bigint) as varchar(20))",
    "return_3yr": "case when o_orderstatus = 'O' then o_orderpriority else substring(o_orderpriority, 1, 1) end",
    "return_5yr": "nullif('0.' || cast(o_custkey as varchar(20)), '0.7')",
    "investment_fee_pct": "case when o_custkey % 11 = 0 then '' else '0.25' end",
    "admin_fee_pct": "case when o_custkey % 13 = 0 then 'NaN' else '1e-3' end",
    "total_fee_pct": "cast(null as varchar(20))",
    "net_assets_m": f"cast({_ORDER_CENTS} as varchar(20)) || case when o_custkey % 7 = 0 then '0000000000000000' else '.5' end",
    "member_accounts": "cast(o_custkey as varchar(20)) || case when o_orderpriority like '1%' then '000000000000000000' else '.5' end",
    "fund_type": "o_orderpriority",
}
_ORDER_PANEL_SQL = ", ".join(f"{value} as {name}" for name, value in _ORDER_PANEL.items())
_KINDS = {**dict.fromkeys(RATES, "decimal(10,6)"), "net_assets_m": "decimal(18,2)", "member_accounts": "bigint"}


def _order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{value} as {name}" for name, value in _ORDER_PANEL.items()])


def _refusals_sql(column: str, kind: str) -> str:
    typed = f"try_cast({column} as {kind})"
    return f"""select abn, product_name, quarter_year, '{column}' as "column", {column} as text,
      case when coalesce(isfinite(try_cast({column} as double)), false) then 'out of range' else 'not a number' end as reason
    from raw where {column} is not null and {typed} is null"""


@query(
    "quarantine",
    f"""with raw as (select {_ORDER_PANEL_SQL} from orders)
    select abn, product_name, quarter_year, 'fund_name' as "column", fund_name as text, 'missing' as reason
    from raw where fund_name is null
    union all
    select abn, product_name, quarter_year, 'quarter_year', quarter_year, 'not a date'
    from raw where quarter_year is not null and try_cast(quarter_year as date) is null
    union all """
    + " union all ".join(_refusals_sql(column, kind) for column, kind in _KINDS.items()),
)
def refused_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of a raw panel that its type refuses, with its row and the reason."""
    return staging.quarantine(staging.parsed(_order_panel(spark, sf_dir)))


@query(
    "staging_lenient",
    f"""with raw as (select {_ORDER_PANEL_SQL} from orders)
    select fund_name, abn, product_name, try_cast(quarter_year as date) as quarter_date,
      {", ".join(f"cast(try_cast({c} as {k}) as double) as {c}" for c, k in _KINDS.items() if c != "member_accounts")},
      try_cast(round(try_cast(member_accounts as decimal(38,6))) as bigint) as member_accounts, lower(fund_type) as fund_type
    from raw where fund_name is not null""",
)
def staged_around_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging view of the same rows: refused values are null, the rest of their row stays."""
    rows = staging.staged_rows(staging.parsed(_order_panel(spark, sf_dir)))
    return rows.withColumns({c: F.col(c).cast("double") for c in [*RATES, "net_assets_m"]})
