"""Standing questions, bounded SELECTs and the catalog."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from panelloom.catalogue import query
from panelloom.catalogue.marts import FLOW_SQL, MARTS_SQL, PERFORMANCE_SQL, VALUE_SQL
from panelloom.plans import marts, questions, selects
from panelloom.standins.panel import PANEL_SQL, panel

FEE_CEILING = 0.05
COMPARED = ["Supplier#000000001", "Supplier#000000007"]


@query(
    "best_under_fee",
    f"""with {PERFORMANCE_SQL} select * from fund_performance
    where quarter_date = (select max(quarter_date) from fund_performance) and total_fee_pct < {FEE_CEILING}
    order by return_5yr desc, abn, fund_name, total_fee_pct limit 1""",
)
def best_under_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.best_under_fee(questions.newest_performance(panel(spark, sf_dir)), FEE_CEILING)


@query(
    "top_losers",
    f"""with {FLOW_SQL} select * from member_flow
    where quarter_date = (select max(quarter_date) from member_flow) order by member_net_change, abn limit 3""",
)
def top_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.top_losers(marts.member_flow(panel(spark, sf_dir)))


@query(
    "compare_fees",
    f"""with {PERFORMANCE_SQL} select fund_name, quarter_date, total_fee_pct from fund_performance
    where fund_name in ('{COMPARED[0]}', '{COMPARED[1]}') and quarter_date >= date '1998-01-01'""",
)
def compare_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.with_five_year_return(panel(spark, sf_dir))
    return questions.compare_fees(rows, COMPARED, date(1998, 1, 1))


@query(
    "top20_overall",
    f"""with {PANEL_SQL} select fund_name, abn, product_name, fund_type, return_5yr
    from panel where quarter_date = (select max(quarter_date) from panel) and return_5yr is not null
    order by return_5yr desc, abn, product_name limit 20""",
)
def top20_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = questions.top_overall(panel(spark, sf_dir))
    return top.select("fund_name", "abn", "product_name", "fund_type", "return_5yr")


@query(
    "top20_by_type",
    f"""with {PANEL_SQL} select fund_name, abn, product_name, fund_type, return_5yr,
      cast(row_number() over (partition by fund_type order by return_5yr desc, abn, product_name) as integer) as place
    from panel where quarter_date = (select max(quarter_date) from panel) and return_5yr is not null
    qualify place <= 20""",
)
def top20_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = questions.top_by_type(panel(spark, sf_dir))
    return top.select("fund_name", "abn", "product_name", "fund_type", "return_5yr", "place")


@query(
    "fee_scatter",
    f"with {VALUE_SQL} select fund_name, abn, product_name, admin_fee_pct as fee, return_1yr, value_quadrant from points",
)
def fee_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.fee_scatter(panel(spark, sf_dir))


@query(
    "flow_last8",
    f"""with {FLOW_SQL} select fund_name, abn, quarter_date, member_net_change from member_flow
    where quarter_date in (select distinct quarter_date from member_flow order by quarter_date desc limit 8)""",
)
def flow_last8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.last_periods(marts.member_flow(panel(spark, sf_dir)))


BOUNDED = """select fund_type, fund_name, quarter_date, member_net_change
from member_flow where member_net_change < 0 order by member_net_change, abn, quarter_date"""


@query("bounded_select", f"with {FLOW_SQL} {BOUNDED} limit 200")
def bounded_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    selects.register_views({"member_flow": marts.member_flow(panel(spark, sf_dir))})
    return selects.select(spark, BOUNDED)


@query(
    "bounded_answer",
    f"""with {FLOW_SQL}, every as ({BOUNDED})
    select *, 'fund_type,fund_name,quarter_date,member_net_change' as column_names,
      cast(least((select count(*) from every), 200) as integer) as row_count,
      (select count(*) from every) > 200 as truncated
    from (select * from ({BOUNDED} limit 200))""",
)
def bounded_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same question with its envelope, which tells whether rows were left."""
    selects.register_views({"member_flow": marts.member_flow(panel(spark, sf_dir))})
    found = selects.answer(spark, BOUNDED)
    return selects.answer_frame(spark, found, selects.reading_query(spark, BOUNDED).schema)

def catalog_sql(name: str, columns: list[str]) -> list[str]:
    types = {"fund_name": "string", "fund_type": "string", "value_quadrant": "string", "quarter_date": "date"}
    whole = ("abn", "member_accounts", "member_net_change", "rolling_annual_member_change", "total_funds_that_quarter")
    return [
        f"select '{name}' as table_name, '{c}' as column_name, "
        f"'{types.get(c, 'bigint' if c in whole or c.startswith('rank_') else 'double')}' as column_type, "
        f"{position} as position, count({c}) as n_values from {name}"
        for position, c in enumerate(columns, start=1)
    ]


@query(
    "mart_catalog",
    f"with {MARTS_SQL} "
    + " union all ".join(
        catalog_sql("fund_performance", marts.PERFORMANCE_COLUMNS)
        + catalog_sql("fee_vs_return", marts.VALUE_COLUMNS)
        + catalog_sql("member_flow", marts.FLOW_COLUMNS)
    ),
)
def mart_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selects.catalog(marts.all_marts(panel(spark, sf_dir)))
