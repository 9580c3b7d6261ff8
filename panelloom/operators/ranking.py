"""Competition ranks and percent ranks among peers, and exact medians.

Each is read off the count of rows per distinct value. Counts combine before
the shuffle, so neither a hot peer group nor a value shared by a third of all
rows gathers in one task; the running totals over the counts are cut in even
chunks (``ordered``). The positions are written, one narrow table for all
rankings, so the wide rows are joined once an order, to a side of known size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.operators.ordered import running_total
from panelloom.session import write_through


@dataclass(frozen=True)
class Ranking:
    """Order the rows of each ``by`` group along ``value``; nulls come last.

    ``rank``, ``percent_rank`` and ``peers`` name the columns to add; a column
    without a name is left out.
    """

    by: tuple[str, ...]
    value: str
    descending: bool = False
    rank: str | None = None
    percent_rank: str | None = None
    peers: str | None = None

    def outputs(self) -> list[Column]:
        rank = F.col("_before") + 1
        share = F.when(F.col("_total") == 1, F.lit(0.0)).otherwise(F.col("_before") / (F.col("_total") - 1))
        named = [(self.rank, rank), (self.percent_rank, share), (self.peers, F.col("_total"))]
        return [column.cast("double" if name == self.percent_rank else "bigint").alias(name) for name, column in named if name]


def with_rankings(df: DataFrame, rankings: Sequence[Ranking], chunks: int | None = None) -> DataFrame:
    """Add the columns of all ``rankings`` to every row of ``df``.

    ``df`` is read twice, so pass a table, or a frame that is cheap to redo.
    Rankings along one value in one direction share a join with the rows.
    """
    groups = sorted({c for r in rankings for c in r.by})
    null = F.lit(None)
    # a key column for each type and direction, so that values are ordered as they are, whatever their type
    kinds = list(dict.fromkeys((df.schema[r.value].dataType, r.descending) for r in rankings))
    place = lambda r: kinds.index((df.schema[r.value].dataType, r.descending))
    keys = [f"_key_{k}" for k in range(len(kinds))]
    branches = [
        F.struct(
            F.lit(i).alias("_ranking"),
            *[(F.col(c) if c in r.by else null.cast(df.schema[c].dataType)).alias(c) for c in groups],
            *[(F.col(r.value) if place(r) == k else null.cast(kinds[k][0])).alias(key) for k, key in enumerate(keys)],
        )
        for i, r in enumerate(rankings)
    ]
    counted = df.select(F.inline(F.array(*branches))).groupBy("_ranking", *groups, *keys).agg(F.count("*").alias("_n"))
    order = [F.desc_nulls_last(key) if kinds[k][1] else F.asc_nulls_last(key) for k, key in enumerate(keys)]
    # written: each ranking reads its own part, and the engine knows how large it is
    positions = write_through(running_total(counted, ["_ranking", *groups], order, "_n", "_before", "_total", chunks), "positions")

    out = df
    for value, descending in dict.fromkeys((r.value, r.descending) for r in rankings):
        alike = [i for i, r in enumerate(rankings) if (r.value, r.descending) == (value, descending)]
        alike.sort(key=lambda i: -len(rankings[i].by))
        widest = rankings[alike[0]]
        found = None
        for i in alike:
            r = rankings[i]
            one = positions.where(F.col("_ranking") == i).select(
                *r.by, F.col(keys[place(r)]).alias("_key"), *r.outputs()
            )
            found = one if found is None else _join_same(found, one, [(c, c) for c in (*r.by, "_key")], "inner")
        keyed = out.withColumn("_key", F.col(widest.value))
        out = _join_same(keyed, found, [(c, c) for c in (*widest.by, "_key")], "left").drop("_key")
    return out


def _join_same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str) -> DataFrame:
    """Join on equal values, null meeting null; the right keys are dropped."""
    right = right.withColumnsRenamed({r: f"_right_{r}" for _, r in pairs})
    same = [F.col(l).eqNullSafe(F.col(f"_right_{r}")) for l, r in pairs]
    return left.join(right, same, how).drop(*[f"_right_{r}" for _, r in pairs])


def exact_medians(df: DataFrame, columns: dict[str, str], chunks: int | None = None) -> DataFrame:
    """One row with the continuous median of each column, ``{column: output}``.

    Nulls are ignored; a column without values gives null. With an even number
    of values the result lies halfway between the two in the middle.
    """
    values = [F.struct(F.lit(c).alias("_measure"), F.col(c).cast("double").alias("_value")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*values)))
        .where(F.col("_value").isNotNull())
        .groupBy("_measure", "_value")
        .agg(F.count("*").alias("_n"))
    )
    seen = running_total(counted, ["_measure"], [F.asc("_value")], "_n", "_before", "_total", chunks)
    last = F.col("_total") - 1
    covers = lambda position: (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
    low, high = covers(F.floor(last / 2)), covers(F.ceil(last / 2))
    middle = seen.where(low | high).select(
        "_measure",
        F.when(low, F.col("_value")).alias("_low"),
        F.when(high, F.col("_value")).alias("_high"),
        F.when(last % 2 == 1, 0.5).otherwise(0.0).alias("_part"),
    )

    def of(column: str, name: str) -> Column:
        return F.max(F.when(F.col("_measure") == column, F.col(name)))

    return middle.agg(
        *[
            F.when(of(c, "_low") == of(c, "_high"), of(c, "_low"))  # also where both are infinite
            .otherwise(of(c, "_low") + (of(c, "_high") - of(c, "_low")) * of(c, "_part"))
            .alias(out)
            for c, out in columns.items()
        ]
    )
