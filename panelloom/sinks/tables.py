"""Writes: dated archive, replaced tables, counted parquet, keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelloom.session import write_through
from panelloom.sources.snapshots import described_snapshot, manifest_path, stored_rows


def archive(cells: DataFrame, root: str, run_date: date) -> list[str]:
    """Keep landed rows under their run date; other dates are left alone.

    Loading a date again replaces only the data sets loaded. Rows are sorted
    inside each task, so that a reader of one sheet, or of header rows alone,
    skips most of a file by its statistics. A row without a data set raises.

    The manifest is written last, read off the files: a description of every
    sheet with its number of rows and a checksum, which readers compare. While
    it is missing or does not fit the files, the date cannot be loaded.
    Returns the folders written, one per data set.
    """
    no_key = F.raise_error(F.lit("a landed row has no data set")).cast("string")
    folder = f"{root}/run_date={run_date.isoformat()}"
    written = Observation("archived")
    (
        cells.drop("run_date")
        .withColumns({"dataset": F.coalesce("dataset", no_key), "cells": F.col("cells").cast("array<string>")})
        .observe(written, F.collect_set("dataset").alias("datasets"), F.count("*").alias("n"))
        .sortWithinPartitions("dataset", "sheet", "row_idx")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset")
        .parquet(folder)
    )
    keys = sorted(written.get["datasets"])
    spark = cells.sparkSession
    manifest = write_through(described_snapshot(stored_rows(spark, root, run_date).where(F.col("dataset").isin(keys))), "manifest")
    stored = manifest.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).first()["n"]
    if stored != written.get["n"]:
        raise RuntimeError(f"{written.get['n']} rows were archived under {folder}, {stored} are there")
    (
        manifest.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset")
        .parquet(manifest_path(root, run_date))
    )
    return [f"{folder}/dataset={key}" for key in keys]


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")


def replace_table(df: DataFrame, table: str, partition: str | None = None) -> int:
    """Replace a managed table in full; returns the rows written, counted on the way."""
    rows = Observation("replaced")
    dealt = df.hint("rebalance", partition) if partition else df
    # counted in the writing stage, after the shuffle, so that a retried map task does not count twice
    writer = dealt.observe(rows, F.count("*").alias("n")).write
    if partition:
        writer = writer.partitionBy(partition)
    writer.mode("overwrite").saveAsTable(table)
    return rows.get["n"]


def replace_partitioned(df: DataFrame, table: str, partition: str) -> int:
    """Replace a table laid out by a column, with the columns in ``df``'s order when it is read.

    A partitioned table keeps its partition column last, so the rows are
    stored in ``<table>_stored`` and ``table`` is a view of them.
    """
    spark, stored = df.sparkSession, f"{table}_stored"
    n = replace_table(df, stored, partition)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM {stored}")
    return n


def write_counted(df: DataFrame, path: str) -> int:
    """Overwrite a parquet folder; the rows are counted in the same job."""
    rows = Observation("written")
    df.observe(rows, F.count("*").alias("n")).write.mode("overwrite").parquet(path)
    return rows.get["n"]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key along ``order``.

    An aggregate instead of a window: copies of a hot key are reduced before
    the shuffle.
    """
    row = F.struct(*df.columns)
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return last.select("_row.*")


def _in_partitions_of(df: DataFrame, updates: DataFrame, partition: str) -> DataFrame:
    """The rows of ``df`` in partitions that ``updates`` touches, the null one among them."""
    touched = updates.select(partition).distinct()
    named = df.join(touched.where(F.col(partition).isNotNull()), partition, "left_semi")
    nulls = touched.where(F.col(partition).isNull()).agg(F.count("*")).scalar()
    return named.unionByName(df.where(F.col(partition).isNull() & (nulls > 0)))


def _table_like(spark: SparkSession, updates: DataFrame, path: str, partition: str) -> DataFrame:
    """The table at ``path`` with its own schema, whose columns must be those of ``updates``."""
    own = spark.read.parquet(path).schema
    kinds = {f.name: f.dataType for f in updates.schema.fields}
    have = {f.name: kinds.get(partition) if f.name == partition else f.dataType for f in own.fields}
    if have != kinds:
        raise ValueError(f"the table has columns {have}, the updates have {kinds}")
    return spark.read.schema(updates.schema).parquet(path)


def upsert(
    spark: SparkSession, updates: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition: str
) -> None:
    """Bring a parquet table partitioned by a part of its key up to date.

    Old and new rows of the touched partitions are merged, the latest per key
    kept, and only those partitions replaced; applying the same updates twice
    changes nothing. The merged rows are written aside first, because a table
    must not be overwritten while it is read; if the last write fails, running
    the same upsert again completes it, as the updates are merged into whatever
    was replaced already. ``path`` must exist and have the updates' columns.

    Rebalancing gathers a partition's rows in few files and splits a large one.
    """
    if partition not in keys:
        raise ValueError(f"partition column {partition!r} must belong to the key {list(keys)}")
    old = _in_partitions_of(_table_like(spark, updates, path, partition), updates, partition)
    merged = latest_per_key(old.select(*updates.columns).unionByName(updates), keys, order)
    (
        write_through(merged, "merged")
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def start_table(df: DataFrame, path: str, partition: str) -> None:
    """The first load of a table that ``upsert`` will keep up to date."""
    df.hint("rebalance", partition).write.mode("errorifexists").partitionBy(partition).parquet(path)
