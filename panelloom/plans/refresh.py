"""Marts brought up to date: only quarters whose staged rows have changed are built again.

A fingerprint of every staged quarter is kept beside the marts. It does not
depend on the order of rows, so the same data gives the same fingerprints
however it was landed. Ranks, percentiles and counts look at one quarter. A
flow looks back: a quarter of a fund is built again where one of the changed
quarters lies between it and the fund's fourth row before, so a row that came,
went or changed in between is seen, wherever the gaps are.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom import fixed_values as fixed
from panelloom.operators.checks import watched
from panelloom.plans import marts
from panelloom.sinks import versions
from panelloom.sinks.versions import in_partitions

QUARTER = "quarter_date"
FINGERPRINTS = "quarter_fingerprints"
BUILT_AS = 1  # raised when marts come to be computed otherwise, which makes every quarter a changed one
CHECKS: dict[str, dict] = {
    "fund_performance": {"not_null": ["abn", QUARTER, "rank_5yr_overall"]},
    "fee_vs_return": {"accepted": {"value_quadrant": fixed.VALUE_QUADRANTS}},
    "member_flow": {"not_null": ["abn", QUARTER]},
}


def fingerprints(staged: DataFrame) -> DataFrame:
    """(quarter_date, n_rows, mixed, added, built_as): the rows of each quarter, but for when and for which run they were loaded."""
    columns = sorted(c for c in staged.columns if not c.startswith("_"))
    # a null is told from an empty text and from a neighbour's value by its place
    marked = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])
    return staged.groupBy(QUARTER).agg(
        F.count("*").alias("n_rows"),
        F.bit_xor(marked).alias("mixed"),
        F.sum(marked.cast("decimal(38,0)")).alias("added"),
        F.lit(BUILT_AS).alias("built_as"),
    )


def changed_quarters(before: DataFrame | None, now: DataFrame) -> set[str | None]:
    """Quarters that came, went or differ, as text; no more than there are quarters."""
    own = now.select(QUARTER, F.struct("n_rows", "mixed", "added", "built_as").alias("now"))
    if before is None:
        return {row["q"] for row in own.select(F.col(QUARTER).cast("string").alias("q")).collect()}
    old = before.select(F.col(QUARTER).alias("_q"), F.struct("n_rows", "mixed", "added", "built_as").alias("before"))
    both = own.join(old, F.col(QUARTER).eqNullSafe(F.col("_q")), "full").where(~F.col("now").eqNullSafe(F.col("before")))
    return {row["q"] for row in both.select(F.coalesce(QUARTER, "_q").cast("string").alias("q")).collect()}


def flow_quarters(staged: DataFrame, changed: Collection[str | None]) -> tuple[set[str], str | None]:
    """The quarters whose flows some changed quarter reaches, and the first quarter that their rows look back to."""
    known = [F.lit(v).cast("date") for v in sorted(v for v in changed if v is not None)]
    if not known:
        return set(), None
    # a fund has no more rows here than there are quarters
    fund = Window.partitionBy("abn").orderBy(QUARTER)
    rows = marts.fund_grain(staged).where("member_accounts is not null").select("abn", QUARTER)
    seen = rows.withColumns({"fourth": F.lag(QUARTER, fixed.ROLLING_QUARTERS).over(fund), "first": F.first(QUARTER).over(fund)})
    back = F.coalesce("fourth", F.lit("0001-01-01").cast("date"))
    reached = seen.where(F.exists(F.array(*known), lambda q: (q <= F.col(QUARTER)) & (q >= back)))
    found = reached.groupBy(QUARTER).agg(F.min(F.coalesce("fourth", "first")).alias("since"))
    rows = found.select(F.col(QUARTER).cast("string").alias("q"), F.col("since").cast("string").alias("since")).collect()
    return {row["q"] for row in rows}, min((row["since"] for row in rows), default=None)


def _parts(staged: DataFrame, schema: str, changed: set[str | None], newest: str | None) -> dict[str, tuple[DataFrame, set[str | None]]]:
    """For each mart the rows to write and the partitions they stand for."""
    spark = staged.sparkSession
    parts: dict[str, tuple[DataFrame, set[str | None]]] = {}
    if changed:
        parts["fund_performance"] = marts.fund_performance(in_partitions(staged, QUARTER, changed)), changed
        reached, since = flow_quarters(staged, changed)
        needed = staged.where(F.col(QUARTER) >= F.lit(since).cast("date")) if since else staged.where("false")
        parts["member_flow"] = in_partitions(marts.member_flow(needed), QUARTER, reached), reached | changed
        held = versions.versions_of(spark, f"{schema}.fee_vs_return")
        old = held.values() if held else set()
        if newest in changed or old != {newest}:
            parts["fee_vs_return"] = marts.fee_vs_return(in_partitions(staged, QUARTER, [newest])), {newest, *old}
    return {name: parts[name] for name in marts.MARTS if name in parts}


def refresh_marts(staged: DataFrame, schema: str) -> tuple[dict[str, int], list[Callable[[], list[dict]]], Callable[[], None]]:
    """Bring the marts of ``schema`` up to date with ``staged``, a written table.

    Returns the rows written by mart, the results of the checks that rode on
    the writes, and what to call when all checks have passed: it keeps the
    fingerprints, and until then the quarters count as changed.
    """
    spark, table = staged.sparkSession, f"{schema}.{FINGERPRINTS}"
    now = fingerprints(staged)
    before = spark.table(table) if spark.catalog.tableExists(table) else None
    changed = changed_quarters(before, now)
    newest = staged.agg(F.max(QUARTER).cast("string").alias("q")).first()["q"]
    written, results = {f"{schema}.{name}": 0 for name in marts.MARTS}, []
    for name, (rows, values) in _parts(staged, schema, changed, newest).items():
        counted, found = watched(rows, name, **CHECKS[name])
        written[f"{schema}.{name}"] = versions.replace_partitions(counted, f"{schema}.{name}", QUARTER, values)
        results.append(found)

    def keep() -> None:
        if changed:
            versions.replace(now, table, "built_as")

    return written, results, keep


def newest_mart_rows(spark: SparkSession, mart: str) -> DataFrame:
    """The newest quarter of a stored mart, told by the partitions that its view lists."""
    return versions.newest(spark, mart)
