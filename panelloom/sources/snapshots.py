"""The dated archive of landed sheet rows."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import write_through
from panelloom.sources.sheets import SHEET, described_stored, marked_row_hash, row_hash

CELLS_SCHEMA = "file string, sheet string, sheet_pos int, row_idx int, cells array<string>, dataset string, run_date date"
MANIFEST = "_manifest"
CHECKED_AS = 2  # raised when checksums come to be computed otherwise; manifests of the first kind do not tell it


class Incomplete(RuntimeError):
    """An archived date does not hold what was archived."""


def manifest_path(root: str, run_date: date) -> str:
    """Beside the data sets of a date; listings of the archive pass over the name."""
    return f"{root}/run_date={run_date.isoformat()}/{MANIFEST}"


def stored_rows(spark: SparkSession, root: str, run_date: date, dataset: str | None = None) -> DataFrame:
    folder = f"{root}/run_date={run_date.isoformat()}" + (f"/dataset={dataset}" if dataset else "")
    rows = spark.read.schema(CELLS_SCHEMA).option("basePath", root).parquet(folder)
    kept = rows.where(F.col("run_date") == F.lit(run_date))
    return kept.where(F.col("dataset") == dataset) if dataset else kept


def read_snapshot(spark: SparkSession, root: str, run_date: date, dataset: str | None = None) -> DataFrame:
    """One run's landed rows; only the date's folder is listed and read.

    A date, or a data set of a date, that was never archived raises. Rows are
    not compared with the manifest here; ``verified_snapshot`` does.
    """
    return stored_rows(spark, root, run_date, dataset)


def described_snapshot(rows: DataFrame, checked_as: int = CHECKED_AS) -> DataFrame:
    """The manifest of archived rows: a description and a checksum of every sheet of every data set."""
    row = row_hash() if checked_as == CHECKED_AS else marked_row_hash()
    return described_stored(rows, row, by=["dataset", *SHEET]).withColumn("checked_as", F.lit(checked_as))


def verified_snapshot(spark: SparkSession, root: str, run_date: date, dataset: str) -> tuple[DataFrame, DataFrame]:
    """A data set's rows of a date and the descriptions of its sheets, once they agree with the manifest.

    The descriptions of the sheets also check them: a sheet that is
    missing, too many, or holds other rows than were archived raises
    ``Incomplete``, as does a date whose manifest was never written. Checksums
    are computed as the manifest's were.
    """
    rows = stored_rows(spark, root, run_date, dataset)
    schema = described_snapshot(rows).schema
    try:
        manifest = spark.read.schema(schema).parquet(manifest_path(root, run_date))
    except AnalysisException as error:
        raise Incomplete(f"the archive of {run_date} has no manifest") from error
    promised = manifest.where(F.col("dataset") == dataset)
    kind = promised.select(F.coalesce("checked_as", F.lit(1)).alias("kind")).first()
    found = write_through(described_snapshot(rows, kind["kind"] if kind else CHECKED_AS), "sheets")
    counts = ["n_rows", "width", "checksum"]
    mine = found.select(*SHEET, *[F.col(c).alias(f"_{c}") for c in counts], F.lit(True).alias("_here"))
    theirs = promised.select(*SHEET, *counts, F.lit(True).alias("there"))
    mine = mine.withColumnsRenamed({c: f"_{c}" for c in SHEET})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SHEET]
    agree = F.col("there").eqNullSafe(F.col("_here"))
    for c in counts:
        agree = agree & F.col(c).eqNullSafe(F.col(f"_{c}"))
    wrong = theirs.join(mine, same, "full").where(~agree).select(F.coalesce("file", "_file").alias("file"), F.coalesce("sheet", "_sheet").alias("sheet"))
    some = wrong.orderBy("file", "sheet").limit(5).collect()
    if some:
        raise Incomplete(f"the archive of {run_date} differs from its manifest in {[tuple(r) for r in some]}")
    return rows, found
