"""Marts and the rank, median, lag and flow operators they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.catalogue import query
from panelloom.functions.values import growth_pct
from panelloom.operators.flow import previous_values
from panelloom.operators.quadrant import latest_rows
from panelloom.operators.ranking import Ranking, exact_medians, with_rankings
from panelloom.plans import marts
from panelloom.standins.panel import PANEL_SQL, panel
from panelloom.standins.tables import table

KEY = ["abn", "quarter_date", "product_name"]

GROWTH_SQL = """sign({now} - {before}) * ((abs({now} - {before}) * 20000 + {before}) // (2 * nullif({before}, 0))) / 100.0"""

PERFORMANCE_SQL = f"""{PANEL_SQL},
fund_performance as (
  select fund_name, abn, fund_type, quarter_date, return_1yr, return_3yr, return_5yr, total_fee_pct,
         net_assets_m, member_accounts,
         rank() over best_of_type as rank_5yr_in_type, rank() over best as rank_5yr_overall,
         percent_rank() over cheapest as fee_percentile, count(*) over quarter as total_funds_that_quarter
  from panel where return_5yr is not null
  window quarter as (partition by quarter_date),
         best as (partition by quarter_date order by return_5yr desc),
         best_of_type as (partition by quarter_date, fund_type order by return_5yr desc),
         cheapest as (partition by quarter_date order by total_fee_pct nulls last)
)"""

VALUE_SQL = f"""{PANEL_SQL},
newest as (
  select * from panel where quarter_date = (select max(quarter_date) from panel)
),
compared as (
  select * from newest where total_fee_pct is not null and return_1yr is not null
),
middle as (select median(total_fee_pct) as median_fee, median(return_1yr) as median_return from compared),
points as (
  select *, case
              when return_1yr >= median_return and total_fee_pct <= median_fee then 'best_value'
              when return_1yr >= median_return and total_fee_pct > median_fee then 'expensive_performer'
              when return_1yr < median_return and total_fee_pct <= median_fee then 'cheap_underperformer'
              when return_1yr < median_return and total_fee_pct > median_fee then 'worst_value' end as value_quadrant
  from compared, middle
),
fee_vs_return as (
  select fund_name, abn, fund_type, quarter_date, total_fee_pct, return_1yr, return_5yr, net_assets_m,
         median_fee, median_return, value_quadrant
  from points
)"""


def flow_sql(name: str, rows: str, order: str, extra: str = "") -> str:
    growth = GROWTH_SQL.format(now="member_accounts", before="members_before")
    return f"""{name}_lagged as (
  select *, lag(member_accounts) over w as members_before, lag(net_assets_m) over w as assets_before
  from {rows} where member_accounts is not null
  window w as (partition by abn order by {order})
),
{name} as (
  select fund_name, abn, fund_type, quarter_date, member_accounts, net_assets_m,
         member_accounts - members_before as member_net_change,
         cast({growth} as double) as member_growth_pct,
         net_assets_m - assets_before as asset_net_change_m,
         cast(sum(member_accounts - members_before) over (
           partition by abn order by {order} rows between 3 preceding and current row) as bigint)
           as rolling_annual_member_change{extra}
  from {name}_lagged where members_before is not null
)"""


FLOW_SQL = f"""{PANEL_SQL},
grain as (
  select distinct fund_name, abn, fund_type, quarter_date, member_accounts, net_assets_m from panel
),
{flow_sql("member_flow", "grain", "quarter_date")}"""

MARTS_SQL = ", ".join(
    [PERFORMANCE_SQL, VALUE_SQL.removeprefix(PANEL_SQL).lstrip(","), FLOW_SQL.removeprefix(PANEL_SQL).lstrip(",")]
)


@query("fund_performance", f"with {PERFORMANCE_SQL} select * from fund_performance")
def fund_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fund_performance(panel(spark, sf_dir))


@query("fee_vs_return", f"with {VALUE_SQL} select * from fee_vs_return")
def fee_vs_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fee_vs_return(panel(spark, sf_dir))


@query("member_flow", f"with {FLOW_SQL} select * from member_flow")
def member_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.member_flow(panel(spark, sf_dir))


@query(
    "member_flow_row_grain",
    f"with {PANEL_SQL}, {flow_sql('row_flow', 'panel', 'quarter_date, product_name', ', product_name')} select * from row_flow",
)
def member_flow_row_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.member_flow_row_grain(panel(spark, sf_dir))


@query(
    "quarterly_aggregation",
    f"""with {PANEL_SQL}, ranked as (
      select *, rank() over (partition by quarter_date order by return_5yr desc) as rank_5yr_overall,
             percent_rank() over (partition by quarter_date order by total_fee_pct nulls last) as fee_percentile,
             lag(member_accounts) over (partition by abn order by quarter_date, product_name) as prev_members
      from panel where return_5yr is not null
    )
    select *, member_accounts - prev_members as member_net_change from ranked""",
)
def quarterly_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.quarterly_aggregation(panel(spark, sf_dir))


def _ranked(spark: SparkSession, sf_dir: str, ranking: Ranking, *columns: str) -> DataFrame:
    rows = marts.with_five_year_return(panel(spark, sf_dir)).select(*KEY, *columns)
    return with_rankings(rows, [ranking])


@query(
    "rank_in_type",
    f"""with {PANEL_SQL} select abn, quarter_date, product_name, fund_type, return_5yr,
      rank() over (partition by quarter_date, fund_type order by return_5yr desc) as rank_5yr_in_type
    from panel where return_5yr is not null""",
)
def rank_in_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir, marts.RANK_IN_TYPE, "fund_type", "return_5yr")


@query(
    "rank_overall",
    f"""with {PANEL_SQL} select abn, quarter_date, product_name, return_5yr,
      rank() over (partition by quarter_date order by return_5yr desc) as rank_5yr_overall
    from panel where return_5yr is not null""",
)
def rank_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir, marts.RANK_OVERALL, "return_5yr")


@query(
    "fee_percentile",
    f"""with {PANEL_SQL} select abn, quarter_date, product_name, total_fee_pct,
      percent_rank() over (partition by quarter_date order by total_fee_pct nulls last) as fee_percentile
    from panel where return_5yr is not null""",
)
def fee_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.with_five_year_return(panel(spark, sf_dir)).select(*KEY, "total_fee_pct")
    return with_rankings(rows, [marts.FEE_PERCENTILE])


@query(
    "peer_count",
    f"""with {PANEL_SQL} select abn, quarter_date, product_name,
      count(*) over (partition by quarter_date) as peer_count
    from panel where return_5yr is not null""",
)
def peer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its quarter's number of rows, as the marts count them."""
    rows = marts.with_five_year_return(panel(spark, sf_dir)).select(*KEY, "total_fee_pct")
    return with_rankings(rows, [Ranking(("quarter_date",), "total_fee_pct", peers="peer_count")]).drop("total_fee_pct")


@query(
    "line_price_rank",
    """select l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
      rank() over (partition by l_returnflag order by l_extendedprice desc) as price_rank,
      percent_rank() over (order by l_quantity) as quantity_percentile
    from lineitem""",
)
def line_price_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups hold all line items, a third each, and one group is them all."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_quantity"
    )
    by_flag = Ranking(("l_returnflag",), "l_extendedprice", descending=True, rank="price_rank")
    overall = Ranking((), "l_quantity", percent_rank="quantity_percentile")
    return with_rankings(rows, [by_flag, overall]).drop("l_quantity")


@query(
    "latest_period",
    f"with {PANEL_SQL} select * from panel where quarter_date = (select max(quarter_date) from panel)",
)
def latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(panel(spark, sf_dir), "quarter_date")


@query(
    "peer_medians",
    """select quantile_cont(l_extendedprice, 0.5) as median_price, quantile_cont(l_quantity, 0.5) as median_quantity
    from lineitem""",
)
def peer_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity")
    return exact_medians(rows, {"l_extendedprice": "median_price", "l_quantity": "median_quantity"})


@query(
    "lag_members",
    f"""with {PANEL_SQL} select abn, quarter_date, product_name, member_accounts, net_assets_m,
      lag(member_accounts) over (partition by abn order by quarter_date, product_name) as prev_member_accounts,
      lag(net_assets_m) over (partition by abn order by quarter_date, product_name) as prev_net_assets_m
    from panel""",
)
def lag_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel(spark, sf_dir).select(*KEY, "member_accounts", "net_assets_m")
    previous = {"member_accounts": "prev_member_accounts", "net_assets_m": "prev_net_assets_m"}
    return previous_values(rows, "abn", ["quarter_date", "product_name"], previous)


@query("rolling_flow", f"with {FLOW_SQL} select abn, quarter_date, member_net_change, rolling_annual_member_change from member_flow")
def rolling_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = marts.member_flow(panel(spark, sf_dir))
    return flow.select("abn", "quarter_date", "member_net_change", "rolling_annual_member_change")


@query(
    "growth_pct",
    f"""with daily as (select user_id, cast(ts as date) as day, count(*) as n from events group by all),
    lagged as (select *, lag(n) over (partition by user_id order by day) as n_before from daily)
    select user_id, day, n, cast({GROWTH_SQL.format(now='n', before='n_before')} as double) as growth_pct from lagged""",
)
def growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily events per user against the user's day before; a user has a row a day."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    before = F.lag("n").over(Window.partitionBy("user_id").orderBy("day"))
    return daily.withColumn("growth_pct", growth_pct(F.col("n"), before))
