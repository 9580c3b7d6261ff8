"""Line items seen as a fund panel: supplier = fund, return flag = product.

Every measure is a ratio of exact whole numbers, so that any engine computes
the same double. A measure is null where a fund's quarter has no line of the
kind it is taken over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.session import write_through
from panelloom.standins.tables import table

PANEL_COLUMNS = [
    "fund_name",
    "abn",
    "product_name",
    "quarter_date",
    "return_1yr",
    "return_3yr",
    "return_5yr",
    "investment_fee_pct",
    "admin_fee_pct",
    "total_fee_pct",
    "net_assets_m",
    "member_accounts",
    "fund_type",
]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the whole-number measures."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("abn"),
        F.trunc("l_shipdate", "quarter").alias("quarter_date"),
        F.col("l_returnflag").alias("product_name"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.rint(F.col("l_discount") * 100).cast("bigint").alias("disc"),
        F.rint(F.col("l_tax") * 100).cast("bigint").alias("tax"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )


def funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier key, name and region; the region plays the fund type."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("abn"), F.trim("s_name").alias("fund_name"), F.lower(F.trim("r_name")).alias("fund_type"))
    )


def _ratio(points: str, kind: Column) -> Column:
    top = F.sum(F.when(kind, F.col(points))).cast("double")
    return top / F.nullif(F.lit(100) * F.count(F.when(kind, 1)), F.lit(0).cast("bigint")).cast("double")


def product_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per fund, quarter and product, with its own assets and members."""
    open_line, done = F.col("status") == "O", F.col("status") == "F"
    return (
        lines(spark, sf_dir)
        .groupBy("abn", "quarter_date", "product_name")
        .agg(
            _ratio("tax", F.col("qty") > 38).alias("return_1yr"),
            _ratio("qty", open_line).alias("return_3yr"),
            _ratio("qty", done).alias("return_5yr"),
            _ratio("disc", open_line).alias("investment_fee_pct"),
            _ratio("disc", done).alias("admin_fee_pct"),
            _ratio("disc", F.col("qty") <= 12).alias("total_fee_pct"),
            F.sum(F.when(open_line, F.col("cents"))).alias("cents"),
            F.sum("qty").alias("qty"),
        )
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged panel; written once because the marts read it several times.

    Fund totals repeat on each product row. A fund's quarter has as many rows
    as there are one-letter return flags, which bounds the window.
    """
    fund = Window.partitionBy("abn", "quarter_date")
    rows = (
        product_quarters(spark, sf_dir)
        .withColumn("net_assets_m", F.sum("cents").over(fund).cast("double") / 100)
        .withColumn("member_accounts", F.sum("qty").over(fund))
        .join(funds(spark, sf_dir), "abn")
    )
    return write_through(rows.select(*PANEL_COLUMNS), "panel", partition="quarter_date")


PANEL_SQL = """
lines as (
  select l_suppkey as abn, cast(date_trunc('quarter', l_shipdate) as date) as quarter_date,
         l_returnflag as product_name, l_linestatus as status, cast(l_quantity as bigint) as qty,
         cast(round(l_discount * 100) as bigint) as disc, cast(round(l_tax * 100) as bigint) as tax,
         cast(round(l_extendedprice * 100) as bigint) as cents
  from lineitem
),
products as (
  select abn, quarter_date, product_name,
         cast(sum(tax) filter (where qty > 38) as double) / nullif(100 * count(*) filter (where qty > 38), 0) as return_1yr,
         cast(sum(qty) filter (where status = 'O') as double) / nullif(100 * count(*) filter (where status = 'O'), 0) as return_3yr,
         cast(sum(qty) filter (where status = 'F') as double) / nullif(100 * count(*) filter (where status = 'F'), 0) as return_5yr,
         cast(sum(disc) filter (where status = 'O') as double) / nullif(100 * count(*) filter (where status = 'O'), 0) as investment_fee_pct,
         cast(sum(disc) filter (where status = 'F') as double) / nullif(100 * count(*) filter (where status = 'F'), 0) as admin_fee_pct,
         cast(sum(disc) filter (where qty <= 12) as double) / nullif(100 * count(*) filter (where qty <= 12), 0) as total_fee_pct
  from lines group by abn, quarter_date, product_name
),
totals as (
  select abn, quarter_date, cast(sum(qty) as bigint) as member_accounts from lines group by abn, quarter_date
),
assets as (
  select abn, quarter_date, cast(sum(cents) as double) / 100 as net_assets_m
  from lines where status = 'O' group by abn, quarter_date
),
panel as (
  select trim(s_name) as fund_name, p.abn, product_name, p.quarter_date, return_1yr, return_3yr, return_5yr,
         investment_fee_pct, admin_fee_pct, total_fee_pct, net_assets_m, member_accounts,
         lower(trim(r_name)) as fund_type
  from products p
  join supplier on s_suppkey = p.abn
  join nation on n_nationkey = s_nationkey
  join region on r_regionkey = n_regionkey
  left join totals t on t.abn = p.abn and t.quarter_date = p.quarter_date
  left join assets a on a.abn = p.abn and a.quarter_date = p.quarter_date
)
"""
