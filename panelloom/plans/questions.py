"""The standing questions asked of the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.operators.quadrant import latest_rows, value_quadrants
from panelloom.plans.marts import fund_performance, with_five_year_return


def best_under_fee(performance: DataFrame, ceiling: float, n: int = 1) -> DataFrame:
    """The newest quarter's best five-year return among fees below a ceiling.

    ``performance`` is the stored mart, or that of the newest quarter alone
    (``newest_performance``).
    """
    cheap = latest_rows(performance, "quarter_date").where(F.col("total_fee_pct") < ceiling)
    return cheap.orderBy(F.desc("return_5yr"), "abn", "fund_name", "total_fee_pct").limit(n)


def top_losers(flow: DataFrame, n: int = 3) -> DataFrame:
    """The funds that lost the most members in the newest quarter."""
    return latest_rows(flow, "quarter_date").orderBy("member_net_change", "abn").limit(n)


def newest_performance(panel: DataFrame) -> DataFrame:
    """The newest quarter of the performance mart. Ranks are per quarter, so no other one is ranked."""
    return fund_performance(latest_rows(with_five_year_return(panel), "quarter_date"))


def compare_fees(rows: DataFrame, names: list[str], since: date) -> DataFrame:
    """The fee series of named funds from a date on, off the performance mart or the panel's rows that it has."""
    found = rows.where(F.col("fund_name").isin(names) & (F.col("quarter_date") >= F.lit(since)))
    return found.select("fund_name", "quarter_date", "total_fee_pct")


def top_overall(panel: DataFrame, n: int = 20, types: list[str] | None = None) -> DataFrame:
    """The newest quarter's ``n`` best five-year returns, of all fund types or of some."""
    rows = latest_rows(panel, "quarter_date").where(F.col("return_5yr").isNotNull())
    if types:
        rows = rows.where(F.col("fund_type").isin(types))
    return rows.orderBy(F.desc("return_5yr"), "abn", "product_name").limit(n)


def top_by_type(panel: DataFrame, n: int = 20, types: list[str] | None = None) -> DataFrame:
    """Per fund type the newest quarter's ``n`` best five-year returns.

    Each task keeps at most ``n`` rows per type before the shuffle, so a type
    with a large share of the rows does not gather in one task.
    """
    rows = latest_rows(panel, "quarter_date").where(F.col("return_5yr").isNotNull())
    if types:
        rows = rows.where(F.col("fund_type").isin(types))
    best = Window.partitionBy("fund_type").orderBy(F.desc("return_5yr"), "abn", "product_name")
    return rows.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n)


def fee_scatter(panel: DataFrame, fee: str = "admin_fee_pct", chunks: int | None = None) -> DataFrame:
    """The newest quarter's points: any fee of the panel, one-year return, quadrant."""
    points = value_quadrants(panel, "quarter_date", "total_fee_pct", "return_1yr", chunks=chunks)
    return points.select(
        "fund_name", "abn", "product_name", F.col(fee).alias("fee"), "return_1yr", "value_quadrant"
    )


def last_periods(flow: DataFrame, n: int = 8) -> DataFrame:
    """Net member change per fund over the newest ``n`` quarters that occur."""
    newest = flow.select("quarter_date").distinct().orderBy(F.desc("quarter_date")).limit(n)
    since = newest.agg(F.min("quarter_date")).scalar()
    rows = flow.where(F.col("quarter_date") >= since)
    return rows.select("fund_name", "abn", "quarter_date", "member_net_change")
