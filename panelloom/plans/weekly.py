"""The whole run: archive, load, stage, build the marts, check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from panelloom import fixed_values as fixed
from panelloom.operators.checks import gate, grain_checks, report, row_checks
from panelloom.operators.frames import with_audit
from panelloom.plans.refresh import CHECKS, refresh_marts
from panelloom.plans.staging import parsed, quarantine as refused_values, staged_rows, staging
from panelloom.session import scratch_scope, write_through
from panelloom.sinks.tables import archive, create_schema, replace_table
from panelloom.sources.registry import DATASETS
from panelloom.sources.snapshots import verified_snapshot

PANEL = "product_quarterly"


@dataclass
class Run:
    """What a run wrote: folders, rows per table, and the checks' results."""

    archived: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)


def load_all(
    spark: SparkSession, root: str, run_date: date, loaded_at: datetime, schema: str, keys: list[str] | None = None
) -> dict[str, int]:
    """Replace the raw table of each registered data set, or of ``keys``, from its snapshot.

    All snapshots are compared with their manifests before the first table is
    replaced; one that was never archived, or is not whole, raises. What the
    comparison tells of the sheets serves the reader, too.
    """
    rows = {}
    snapshots = {key: verified_snapshot(spark, root, run_date, key) for key in (DATASETS if keys is None else keys)}
    for key, (snapshot, sheets) in snapshots.items():
        dataset = DATASETS[key]
        cells = snapshot.drop("dataset", "run_date")
        table = f"{schema}.{dataset.table}"
        rows[table] = replace_table(with_audit(dataset.reader(cells, sheets=sheets), loaded_at, run_date), table)
    return rows


def staging_checks(staged: DataFrame, fund_types: list[str]) -> DataFrame:
    """All checks of the staged panel, in one read of it."""
    return grain_checks(
        staged,
        "staging",
        grain=["abn", "quarter_date"],
        within=["product_name"],
        alike=["member_accounts", "net_assets_m", "fund_name", "fund_type"],
        not_null=["abn", "fund_name", "quarter_date"],
        accepted={"fund_type": fund_types},
        row_count=(1, None),
    )


def mart_checks(performance: DataFrame, value: DataFrame, flow: DataFrame) -> DataFrame:
    """The checks of the marts where they are not being written; a run counts them on the writes."""
    built = {"fund_performance": performance, "fee_vs_return": value, "member_flow": flow}
    return report(*[row_checks(df, name, **CHECKS[name]) for name, df in built.items()])


def require_datasets(landed: DataFrame, left_out: Sequence[str]) -> list[str]:
    """The data sets landed: all registered ones but those left out, and no others."""
    found = landed.select("dataset").distinct().limit(len(DATASETS) + 2).collect()
    keys = {row["dataset"] for row in found}
    wanted = set(DATASETS) - set(left_out)
    if keys != wanted:
        raise ValueError(f"landed data sets are {sorted(map(str, keys))}, expected {sorted(wanted)}")
    return sorted(keys)


def weekly_run(
    spark: SparkSession,
    landed: DataFrame,
    root: str,
    run_date: date,
    loaded_at: datetime,
    raw_schema: str = "raw",
    mart_schema: str = "mart",
    fund_types: list[str] = fixed.FUND_TYPES,
    left_out: Sequence[str] = (),
    quarantine: str | None = None,
) -> Run:
    """One run under one date. A failing check raises after the marts are built.

    Every registered data set must be landed, but those named in ``left_out``;
    a null or unknown one raises. Nothing is replaced before that is known.
    Without the product data set the marts stay as they are. The staged panel
    is written once, by quarter, and read by all marts and checks; the marts
    are laid out by quarter, too, so that questions about the newest quarter
    read nothing else. Only quarters that have changed since the last run are
    built again (``refresh``), readers of the marts see old rows or new ones. Intermediate tables go at the end, also after a
    failure; what the run leaves, tables and the staging view, needs none.

    A value that does not fit its type raises. With ``quarantine``, the name of
    a table, it is null in the staged panel instead and listed there with its
    row and the reason; the table is replaced by every run that builds marts.
    """
    with scratch_scope(spark):
        keys = require_datasets(landed, left_out)
        run = Run(archived=archive(landed, root, run_date))
        create_schema(spark, raw_schema)
        create_schema(spark, mart_schema)
        run.rows = load_all(spark, root, run_date, loaded_at, raw_schema, keys)
        if PANEL in keys:
            _build_marts(spark, run, f"{raw_schema}.{DATASETS[PANEL].table}", mart_schema, fund_types, quarantine)
    return run


def _build_marts(
    spark: SparkSession, run: Run, raw: str, mart_schema: str, fund_types: list[str], quarantine: str | None
) -> None:
    if quarantine is None:
        staging(spark.table(raw)).createOrReplaceTempView("staging")
        staged = write_through(spark.table("staging"), "staging", partition="quarter_date")
    else:
        staging(spark.table(raw), strict=False).createOrReplaceTempView("staging")
        rows = write_through(parsed(spark.table(raw)), "staging", partition="quarter_date")
        run.rows[quarantine] = replace_table(refused_values(rows), quarantine)
        staged = staged_rows(rows)
    written, results, keep = refresh_marts(staged, mart_schema)
    run.rows |= written
    checked = [row.asDict() for row in staging_checks(staged, fund_types).collect()]
    run.checks = gate(checked + [row for found in results for row in found()])
    keep()
