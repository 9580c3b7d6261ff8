"""Tables that readers see whole while they change, in full or by partition.

A table is a view. Its rows lie in generations, stored tables laid out by one
column, and the view tells for each generation the partitions that it still
holds. A change writes a new generation and then alters the view, which is one
step of the catalog: a reader meets the old rows or the new ones, and the old
ones stay if anything fails before. A generation that holds nothing any more
is dropped at the change after, so queries that still read it can end.

What the view holds is kept in its own text. It lists partitions, not files or
rows; a question about the newest partition needs no more than that.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelloom.session import seen_by
from panelloom.sinks.tables import latest_per_key

_MARK = re.compile(r"/\* generations (.*?) \*/", re.DOTALL)


@dataclass
class Versions:
    """Column names, the partition column with its type, the partitions of each generation, and what to drop next."""

    columns: list[str]
    partition: str
    kind: str
    held: dict[str, list[str | None]]
    retired: list[str] = field(default_factory=list)

    def values(self) -> set[str | None]:
        return {v for values in self.held.values() for v in values}


def versions_of(spark: SparkSession, table: str) -> Versions | None:
    """What ``table`` holds now, or None if there is no such view."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").collect()
    found = _MARK.search(rows[0]["data_type"]) if rows else None
    if not found:
        raise ValueError(f"{table} is there, but not as a view of generations")
    return Versions(**json.loads(found.group(1)))


def _literal(value: str, kind: str) -> str:
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


def _query(now: Versions) -> str:
    # a slash is escaped, so that no value ends the comment
    state = json.dumps(now.__dict__).replace("/", "\\/")
    names = ", ".join(f"`{c}`" for c in now.columns)
    parts = []
    for generation, values in now.held.items():
        known = [_literal(v, now.kind) for v in sorted(v for v in values if v is not None)]
        kept = [f"`{now.partition}` IN ({', '.join(known)})"] if known else []
        kept += [f"`{now.partition}` IS NULL"] if None in values else []
        parts.append(f"SELECT {names} FROM {generation} WHERE {' OR '.join(kept) or 'false'}")
    head, *rest = parts
    return " UNION ALL ".join([head.replace("SELECT ", f"SELECT /* generations {state} */ ", 1), *rest])


def _switch(spark: SparkSession, table: str, now: Versions, exists: bool) -> None:
    spark.sql(f"ALTER VIEW {table} AS {_query(now)}" if exists else f"CREATE VIEW {table} AS {_query(now)}")


def _stored(df: DataFrame, table: str, partition: str) -> tuple[str, list[str | None], int]:
    """Write a new generation; its name, its partitions and its rows, both counted on the way."""
    name, seen = f"{table}_g{uuid.uuid4().hex[:12]}", Observation("generation")
    values = F.collect_set(F.col(partition).cast("string"))
    counted = df.hint("rebalance", partition).observe(
        seen, values.alias("known"), F.count_if(F.col(partition).isNull()).alias("nulls"), F.count("*").alias("n")
    )
    counted.write.partitionBy(partition).saveAsTable(name)
    found = seen_by(seen, {"known": [], "nulls": 0, "n": 0})
    return name, [*sorted(found["known"]), *([None] if found["nulls"] else [])], found["n"]


def _changed(spark: SparkSession, table: str, old: Versions | None, new: Versions) -> None:
    if old is not None:
        new.retired = [g for g in old.held if g not in new.held]
    _switch(spark, table, new, old is not None)
    for name in old.retired if old else []:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace(df: DataFrame, table: str, partition: str) -> int:
    """Replace ``table`` in full; returns the rows written."""
    spark = df.sparkSession
    old = versions_of(spark, table)
    name, values, n = _stored(df, table, partition)
    _changed(spark, table, old, Versions(df.columns, partition, df.schema[partition].dataType.simpleString(), {name: values}))
    return n


def replace_partitions(df: DataFrame, table: str, partition: str, values: Collection[str | None]) -> int:
    """Replace the partitions ``values`` of ``table``, as text, by the rows of ``df``, which must lie in them; returns the rows written.

    A partition without rows in ``df`` is then empty. Other partitions are not
    written and stay where they are. Without a table the rows become one.
    """
    spark = df.sparkSession
    old = versions_of(spark, table)
    if old is None:
        return replace(df, table, partition)
    kind = df.schema[partition].dataType.simpleString()
    if (old.columns, old.partition, old.kind) != (df.columns, partition, kind):
        raise ValueError(f"{table} has columns {old.columns} by {old.partition}, the rows have {df.columns} by {partition}")
    gone = set(values)
    name, found, n = _stored(df, table, partition)
    if not set(found) <= gone:
        spark.sql(f"DROP TABLE {name}")
        raise ValueError(f"rows for {table} lie in other partitions: {sorted(map(str, set(found) - gone))[:5]}")
    held = {g: [v for v in kept if v not in gone] for g, kept in old.held.items()}
    held = {g: kept for g, kept in held.items() if kept}
    if n or not held:
        held[name] = found
    new = Versions(old.columns, partition, kind, held)
    _changed(spark, table, old, new)
    if name not in held:
        spark.sql(f"DROP TABLE {name}")
    return n


def upsert(updates: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Bring ``table`` up to date by key; returns the rows of the partitions written.

    Old and new rows of the touched partitions are merged and the latest of
    each key kept. The same updates again change no row. The partition column
    must belong to the key.
    """
    spark = updates.sparkSession
    old = versions_of(spark, table)
    if old is None or old.partition not in keys:
        raise ValueError(f"{table} must exist and be laid out by a column of the key {list(keys)}")
    column = F.col(old.partition)
    touched = [row["value"] for row in updates.select(column.cast("string").alias("value")).distinct().collect()]
    if not touched:
        return 0
    before = in_partitions(spark.table(table), old.partition, touched)
    merged = latest_per_key(before.select(*old.columns).unionByName(updates.select(*old.columns)), keys, order)
    return replace_partitions(merged, table, old.partition, touched)


def in_partitions(df: DataFrame, partition: str, values: Collection[str | None]) -> DataFrame:
    """The rows of ``df`` in some partitions, given as text, by a filter that leaves the others unread."""
    kind, column = df.schema[partition].dataType, F.col(partition)
    known = [F.lit(v).cast(kind) for v in sorted(v for v in values if v is not None)]
    kept = column.isin(*known) if known else F.lit(False)
    return df.where(kept | column.isNull() if None in values else kept)


def newest(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the largest partition value of ``table``, found without reading a row."""
    now = versions_of(spark, table)
    known = [F.lit(v).cast(now.kind) for v in now.values() if v is not None]
    if not known:
        return spark.table(table).where("false")
    last = spark.range(1).select(F.array_max(F.array(*known)).cast("string").alias("last")).first()["last"]
    return in_partitions(spark.table(table), now.partition, [last])
