"""Period-on-period changes per entity and their rolling sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelloom.fixed_values import ROLLING_QUARTERS
from panelloom.functions.values import growth_pct
from panelloom.operators.ordered import with_lookback


def entity_grain(
    panel: DataFrame, entity: str, period: str, totals: Sequence[str], labels: Sequence[str] = ()
) -> DataFrame:
    """One row per entity and period out of a panel that repeats entity totals.

    Totals and labels are equal within an entity and period; ``checks`` can
    prove that with ``grain_conflicts``. The counts of rows combine before the
    shuffle, and afterwards an entity has no more rows than there are periods.
    """
    return panel.groupBy(entity, period).agg(
        *[F.max(c).alias(c) for c in totals], *[F.min(c).alias(c) for c in labels]
    )


def _changes(frame: DataFrame, window: WindowSpec, members: str, assets: str) -> DataFrame:
    frame = frame.withColumns(
        {"_members_before": F.lag(members).over(window), "_assets_before": F.lag(assets).over(window)}
    )
    return frame.withColumns(
        {
            "member_net_change": (F.col(members) - F.col("_members_before")).cast("bigint"),
            "member_growth_pct": growth_pct(F.col(members), F.col("_members_before")),
            "asset_net_change_m": F.col(assets) - F.col("_assets_before"),
        }
    )


def _rolling(frame: DataFrame, window: WindowSpec) -> DataFrame:
    """Sum the last changes; the first row of an entity has none to add."""
    year = window.rowsBetween(1 - ROLLING_QUARTERS, 0)
    return frame.withColumn("rolling_annual_member_change", F.sum("member_net_change").over(year).cast("bigint"))


def _finish(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("_members_before").isNotNull()).drop("_members_before", "_assets_before")


def period_flow(grain: DataFrame, entity: str, period: str, members: str, assets: str) -> DataFrame:
    """Changes and rolling sums at entity grain; the first period drops out.

    ``grain`` has one row per entity and period, so a window partition is
    bounded by the number of periods.
    """
    window = Window.partitionBy(entity).orderBy(period)
    rows = grain.where(F.col(members).isNotNull())
    return _finish(_rolling(_changes(rows, window, members, assets), window))


def row_flow(
    panel: DataFrame,
    entity: str,
    order: Sequence[str],
    members: str,
    assets: str,
    chunks: int | None = None,
) -> DataFrame:
    """The same at the panel's own grain, in the total order ``order``.

    An entity may hold any share of the rows here, so the window runs in
    chunks: a rolling sum of changes looks one row further back than its frame.
    """
    rows = panel.where(F.col(members).isNotNull())

    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return _rolling(_changes(frame, window, members, assets), window)

    return _finish(with_lookback(rows, [entity], order, ROLLING_QUARTERS, add, chunks))


def previous_values(
    panel: DataFrame, entity: str, order: Sequence[str], previous: dict[str, str], chunks: int | None = None
) -> DataFrame:
    """Add the entity's preceding row's values, ``{column: output}``; all rows stay."""

    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumns({out: F.lag(c).over(window) for c, out in previous.items()})

    return with_lookback(panel, [entity], order, 1, add, chunks)
