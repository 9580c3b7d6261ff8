"""Declarative data checks with one results schema.

Every check yields rows ``(table_name, column_name, check_name, failures)``.
Checks that look at rows one by one share a single pass over the table, and may
ride on its write.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelloom.operators.frames import drop_null_key
from panelloom.session import seen_by

RESULT_COLUMNS = ["table_name", "column_name", "check_name", "failures"]


Declared = list[tuple[str, str, Column]]


def _row_failures(not_null: Sequence[str], accepted: Mapping[str, Sequence[str]] | None) -> Declared:
    """(column, check, whether a row fails it) of the checks that look at single rows."""
    found = [(c, "not_null", F.col(c).isNull()) for c in not_null]
    return found + [(c, "accepted_values", ~F.col(c).isin(list(values))) for c, values in (accepted or {}).items()]


def _outside(n: Column, bounds: tuple[int, int | None]) -> Column:
    low, high = bounds
    return F.when((n < low) if high is None else (n < low) | (n > high), 1).otherwise(0)


def _as_rows(df: DataFrame, table: str, counts: Declared) -> DataFrame:
    """One row of results for each aggregate."""
    results = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(check).alias("check_name"),
                failures.cast("bigint").alias("failures"),
            )
            for column, check, failures in counts
        ]
    )
    return df.agg(results.alias("results")).select(F.inline("results"))


def row_checks(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    row_count: tuple[int, int | None] | None = None,
) -> DataFrame:
    """Null counts, values outside a list (null passes) and bounds on the rows."""
    counts = [(c, check, F.count_if(fails)) for c, check, fails in _row_failures(not_null, accepted)]
    if row_count:
        counts.append(("*", "row_count", _outside(F.count("*"), row_count)))
    return _as_rows(df, table, counts)


def watched(
    df: DataFrame, table: str, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None
) -> tuple[DataFrame, Callable[[], list[dict]]]:
    """``df`` with its row checks counted by whatever reads it next, such as its own write; and the results from then on.

    Nothing is read a second time for the checks. A stage that is run again
    after a lost executor may count a failure twice, but none appears or goes.
    """
    declared, seen = _row_failures(not_null, accepted), Observation(f"checks of {table}")
    counts = [F.count_if(fails).alias(f"c{i}") for i, (_, _, fails) in enumerate(declared)]

    def results() -> list[dict]:
        found = seen_by(seen, {f"c{i}": 0 for i in range(len(declared))})
        return [dict(zip(RESULT_COLUMNS, (table, c, check, found[f"c{i}"]))) for i, (c, check, _) in enumerate(declared)]

    return df.observe(seen, *counts), results


def grain_checks(
    df: DataFrame,
    table: str,
    grain: Sequence[str],
    within: Sequence[str],
    alike: Sequence[str],
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    row_count: tuple[int, int | None] | None = None,
) -> DataFrame:
    """``row_checks``, and that grain and ``within`` are unique and ``alike`` columns are the same in a grain, in one read of ``df``.

    Rows are counted by the longer key, then by the grain, then in all; each
    step combines before its shuffle, so a hot grain does not gather. A key
    with a null part is not compared for being unique. Texts are compared by
    two hashes of 64 bits: an aggregate of numbers alone needs no sort.
    """
    declared = _row_failures(not_null, accepted)
    fails = [f"_fails_{i}" for i in range(len(declared))]
    keys = [*grain, *within]
    named = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    texts = [c for c in alike if isinstance(df.schema[c].dataType, StringType)]
    hashes = {f"_hash_{i}_{c}": F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(i), F.col(c))) for c in texts for i in range(2)}
    alike = [*[c for c in alike if c not in texts], *hashes]
    by_key = df.withColumns(hashes).groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *[F.count_if(failing).alias(name) for name, (_, _, failing) in zip(fails, declared)],
        *[f(c).alias(f"_{f.__name__}_{c}") for c in alike for f in (F.min, F.max, F.count)],
    )
    by_grain = by_key.groupBy(*grain).agg(
        F.count_if(named & (F.col("_n") > 1)).alias("_repeated"),
        F.sum("_n").alias("_n"),
        *[F.sum(name).alias(name) for name in fails],
        *[g(f"_{f}_{c}").alias(f"_{f}_{c}") for c in alike for f, g in (("min", F.min), ("max", F.max), ("count", F.sum))],
    )
    some = lambda c: F.col(f"_count_{c}")
    differs = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(f"_min_{c}") != F.col(f"_max_{c}"), F.lit(False)) | ((some(c) > 0) & (some(c) < F.col("_n"))) for c in alike],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = [(c, check, total(name)) for name, (c, check, _) in zip(fails, declared)]
    if row_count:
        counts.append(("*", "row_count", _outside(total("_n"), row_count)))
    counts += [(", ".join(keys), "unique", total("_repeated")), (", ".join(grain), "one_total", F.count_if(differs))]
    return _as_rows(by_grain, table, counts)


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The values outside the list, with their numbers of rows; null passes."""
    return df.where(~F.col(column).isin(list(values))).groupBy(column).agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a null part is not compared."""
    return drop_null_key(df, *keys).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key the parent does not have; a null key passes."""
    known = parent.select(F.col(parent_key).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    present = child.where(F.col(key).isNotNull())
    return present.join(known, F.col(key) == F.col("_known"), "left_anti")


def grain_conflicts(df: DataFrame, keys: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Keys whose totals are not the same on all of their rows."""
    differs = reduce(
        lambda a, b: a | b,
        [
            (F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count("*")))
            for c in totals
        ],
    )
    return df.groupBy(*keys).agg(F.coalesce(differs, F.lit(False)).alias("_differs")).where("_differs").drop("_differs")


def as_result(bad: DataFrame, table: str, column: str, check: str) -> DataFrame:
    """The number of offending rows or keys as one row of results."""
    return bad.agg(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.count("*").alias("failures"),
    )


def report(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


class ChecksFailed(RuntimeError):
    """Raised by ``gate`` with the failing checks."""


def gate(results: DataFrame | list[dict]) -> list[dict]:
    """Run the checks, or take the rows of those that ran, and stop the run when one has failures.

    The results hold one row per declared check, whatever the tables' sizes.
    """
    rows = results if isinstance(results, list) else [row.asDict() for row in results.collect()]
    failed = [row for row in rows if row["failures"] > 0]
    if failed:
        raise ChecksFailed("; ".join("{table_name}.{column_name} {check_name}: {failures}".format(**r) for r in failed))
    return rows
