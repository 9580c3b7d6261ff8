"""Small steps on any table: drops, renames, projections, a shape report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="all", subset=list(columns) if columns else None)


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.select([c for c in df.columns if not c.startswith("unnamed")])


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def project_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep those of the listed columns that exist, in the order of the list."""
    return df.select([c for c in columns if c in df.columns])


def drop_null_key(df: DataFrame, *keys: str) -> DataFrame:
    """Keep rows that have every key, as filters the optimizer can push and merge."""
    return reduce(lambda kept, key: kept.where(F.col(key).isNotNull()), keys, df)


def with_audit(df: DataFrame, loaded_at, run_date) -> DataFrame:
    """Add when and for which run the rows were loaded; both come from the caller."""
    return df.withColumns(
        {"_loaded_at": F.lit(loaded_at).cast("timestamp"), "_run_date": F.lit(run_date).cast("date")}
    )


def sum_per_key(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Sum per key; a group without values gives 0, rows without a key go."""
    return drop_null_key(df, *keys).groupBy(*keys).agg(F.coalesce(F.sum(amount), F.lit(0)).alias(amount))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows met, each as one JSON text, to go with the shape."""
    return df.limit(n).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def shape(df: DataFrame, name: str) -> DataFrame:
    """One row with the table's name and its numbers of rows and columns."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )
