"""Value for money: each entity against the medians of cost and gain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.fixed_values import VALUE_QUADRANTS
from panelloom.operators.ranking import exact_medians


def latest_rows(panel: DataFrame, period: str) -> DataFrame:
    """The rows of the newest period found anywhere in ``panel``."""
    return panel.where(F.col(period) == panel.agg(F.max(period)).scalar())


def value_quadrants(
    panel: DataFrame,
    period: str,
    cost: str,
    gain: str,
    median_cost: str = "median_fee",
    median_gain: str = "median_return",
    quadrant: str = "value_quadrant",
    chunks: int | None = None,
) -> DataFrame:
    """Classify the newest period's rows that have both measures.

    The newest period is found before rows without measures are left out: when
    it has no measures yet, the result is empty. A value at the median counts
    as cheap, or as performing.
    """
    rows = latest_rows(panel, period).where(F.col(cost).isNotNull() & F.col(gain).isNotNull())
    medians = exact_medians(rows, {cost: median_cost, gain: median_gain}, chunks)
    both = medians.select(F.struct(median_cost, median_gain)).scalar()
    best, expensive, cheap, worst = VALUE_QUADRANTS
    is_cheap = F.col(cost).cast("double") <= F.col(median_cost)
    performs = F.col(gain).cast("double") >= F.col(median_gain)
    return (
        rows.withColumn("_medians", both)
        .withColumns({median_cost: F.col("_medians")[median_cost], median_gain: F.col("_medians")[median_gain]})
        .drop("_medians")
        .withColumn(
            quadrant,
            F.when(performs, F.when(is_cheap, best).otherwise(expensive)).otherwise(
                F.when(is_cheap, cheap).otherwise(worst)
            ),
        )
    )
