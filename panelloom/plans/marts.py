"""The three fund marts and the combined job, over a staged fund panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.flow import entity_grain, period_flow, previous_values, row_flow
from panelloom.operators.quadrant import value_quadrants
from panelloom.operators.ranking import Ranking, with_rankings

RANK_IN_TYPE = Ranking(("quarter_date", "fund_type"), "return_5yr", descending=True, rank="rank_5yr_in_type")
RANK_OVERALL = Ranking(("quarter_date",), "return_5yr", descending=True, rank="rank_5yr_overall")
FEE_PERCENTILE = Ranking(("quarter_date",), "total_fee_pct", percent_rank="fee_percentile")
FEE_PERCENTILE_AND_COUNT = Ranking(
    ("quarter_date",), "total_fee_pct", percent_rank="fee_percentile", peers="total_funds_that_quarter"
)

PERFORMANCE_COLUMNS = [
    "fund_name",
    "abn",
    "fund_type",
    "quarter_date",
    "return_1yr",
    "return_3yr",
    "return_5yr",
    "total_fee_pct",
    "net_assets_m",
    "member_accounts",
    "rank_5yr_in_type",
    "rank_5yr_overall",
    "fee_percentile",
    "total_funds_that_quarter",
]
VALUE_COLUMNS = [
    "fund_name",
    "abn",
    "fund_type",
    "quarter_date",
    "total_fee_pct",
    "return_1yr",
    "return_5yr",
    "net_assets_m",
    "median_fee",
    "median_return",
    "value_quadrant",
]
FLOW_COLUMNS = [
    "fund_name",
    "abn",
    "fund_type",
    "quarter_date",
    "member_accounts",
    "net_assets_m",
    "member_net_change",
    "member_growth_pct",
    "asset_net_change_m",
    "rolling_annual_member_change",
]


def with_five_year_return(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("return_5yr").isNotNull())


def fund_performance(panel: DataFrame, chunks: int | None = None) -> DataFrame:
    """Returns ranked per quarter, overall and in the fund type, and fee percentile."""
    rankings = [RANK_IN_TYPE, RANK_OVERALL, FEE_PERCENTILE_AND_COUNT]
    return with_rankings(with_five_year_return(panel), rankings, chunks).select(*PERFORMANCE_COLUMNS)


def fee_vs_return(panel: DataFrame, chunks: int | None = None) -> DataFrame:
    """The newest quarter's fee and one-year return against their medians."""
    rows = value_quadrants(panel, "quarter_date", "total_fee_pct", "return_1yr", chunks=chunks)
    return rows.select(*VALUE_COLUMNS)


def fund_grain(panel: DataFrame) -> DataFrame:
    return entity_grain(
        panel, "abn", "quarter_date", ["member_accounts", "net_assets_m"], ["fund_name", "fund_type"]
    )


def member_flow(panel: DataFrame) -> DataFrame:
    """Quarterly member and asset changes per fund and the rolling year."""
    flow = period_flow(fund_grain(panel), "abn", "quarter_date", "member_accounts", "net_assets_m")
    return flow.select(*FLOW_COLUMNS)


def member_flow_row_grain(panel: DataFrame, chunks: int | None = None) -> DataFrame:
    """The flow over product rows as they stand, products in name order."""
    order = ["quarter_date", "product_name"]
    rows = panel.select("fund_name", "abn", "fund_type", *order, "member_accounts", "net_assets_m")
    flow = row_flow(rows, "abn", order, "member_accounts", "net_assets_m", chunks)
    return flow.select(*FLOW_COLUMNS, "product_name")


def quarterly_aggregation(panel: DataFrame, chunks: int | None = None) -> DataFrame:
    """All columns of the panel, ranked per quarter, with the change in members.

    The earlier row is looked up first: cutting the rows in order samples its
    input, which is then a scan and not the rankings' joins.
    """
    order = ["quarter_date", "product_name"]
    rows = previous_values(with_five_year_return(panel), "abn", order, {"member_accounts": "prev_members"}, chunks)
    ranked = with_rankings(rows, [RANK_OVERALL, FEE_PERCENTILE], chunks)
    return ranked.withColumn("member_net_change", F.col("member_accounts") - F.col("prev_members"))


MARTS = {"fund_performance": fund_performance, "fee_vs_return": fee_vs_return, "member_flow": member_flow}


def all_marts(panel: DataFrame) -> dict[str, DataFrame]:
    return {name: build(panel) for name, build in MARTS.items()}
