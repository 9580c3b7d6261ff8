"""Ordered computations whose groups may be far larger than one task.

A window partitioned by a period or an entity sorts each group in one task,
so one hot group stalls the job. Here the rows are range-partitioned on the
full order instead: chunks are even whatever the groups are. What a chunk has
to know of the chunks before it is carried in as extra rows, and an ordinary
window inside the chunk does the rest.

The chunk number of a row has to be the same for every reader, so the cut
rows are written once to the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelloom.session import write_through

CHUNK = "_chunk"
CARRIED = "_carried"


def cut_in_order(df: DataFrame, order: Sequence[Column], chunks: int | None = None) -> DataFrame:
    """Tag each row with the number of its chunk along ``order``.

    Without ``chunks`` the number follows ``spark.sql.shuffle.partitions`` and
    adaptive execution merges small neighbours.
    """
    size = [chunks] if chunks else []
    cut = df.repartitionByRange(*size, *order).withColumn(CHUNK, F.spark_partition_id())
    return write_through(cut, "cut")


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    amount: str,
    before: str,
    total: str,
    chunks: int | None = None,
) -> DataFrame:
    """Add the sum of ``amount`` over the group's earlier rows and over the group.

    ``order`` must not tie within a group. Carried into each chunk is one row
    per group: the sum of the group's earlier chunks.
    """
    rows = cut_in_order(df, [*map(F.asc, by), *order], chunks)
    group = Window.partitionBy(*by)
    earlier = group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*by, CHUNK)
        .agg(F.sum(amount).alias("_sum"))
        .select(
            *by,
            CHUNK,
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(amount),
            F.sum("_sum").over(group).alias(total),
            F.lit(True).alias(CARRIED),
        )
    )
    piece = Window.partitionBy(*by, CHUNK)
    in_piece = piece.orderBy(F.desc(CARRIED), *order)
    return (
        rows.withColumn(CARRIED, F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn(before, F.sum(amount).over(in_piece.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn(total, F.max(total).over(in_piece.rowsBetween(Window.unboundedPreceding, 0)))
        .where(~F.col(CARRIED))
        .drop(CARRIED, CHUNK)
    )


def with_lookback(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    rows_back: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    chunks: int | None = None,
) -> DataFrame:
    """Run window expressions that look at most ``rows_back`` rows back.

    ``add(frame, window)`` gets an ordinary window (by group, in ``order``) and
    may add columns but must keep the rows. ``order`` must not tie in a group.
    """
    rows = cut_in_order(df, [F.asc(c) for c in (*by, *order)], chunks)
    carried = _last_rows_before(rows, list(by), list(order), rows_back)
    window = Window.partitionBy(*by, CHUNK).orderBy(*order)
    both = rows.withColumn(CARRIED, F.lit(False)).unionByName(carried)
    return add(both, window).where(~F.col(CARRIED)).drop(CARRIED, CHUNK)


def _last_rows_before(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """For each piece of a group cut in several: the ``n`` rows before it.

    A group in several chunks crosses a chunk's edge, so there are fewer such
    groups than chunks. Each piece hands on at most ``n`` rows.
    """
    columns = [c for c in rows.columns if c != CHUNK]
    cut_groups = (
        rows.groupBy(*by)
        .agg(F.min(CHUNK).alias("first"), F.max(CHUNK).alias("last"))
        .where("first < last")
        .select(*[F.col(c).alias(f"_g_{c}") for c in by])
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]
    backwards = Window.partitionBy(*by, CHUNK).orderBy(*[F.desc(c) for c in order])
    tails = (
        rows.join(cut_groups, same, "left_semi")
        .withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") <= n)
        .groupBy(*by, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct("_back", F.struct(*columns).alias("row"))), asc=False).alias("tail"))
    )
    pieces = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(-n, -1)
    return (
        tails.select(CHUNK, F.flatten(F.collect_list("tail").over(pieces)).alias("seen"))
        .select(CHUNK, F.explode(F.slice("seen", F.greatest(F.lit(1), F.size("seen") - n + 1), F.lit(n))).alias("kept"))
        .select(*[F.col("kept.row")[c].alias(c) for c in columns], CHUNK, F.lit(True).alias(CARRIED))
    )
