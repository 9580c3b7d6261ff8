"""Bounded read-only questions in SQL, and the catalog they may use."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.fixed_values import RESULT_CAP
from panelloom.plans.guard import Refused, require_readable
from panelloom.plans.marts import MARTS

# Relations a question may name: the marts, as views or as tables of their schema.
READABLE = (*MARTS, *(f"mart.{name}" for name in MARTS))


@dataclass(frozen=True)
class Answer:
    """Column names and rows of a bounded result; ``truncated`` tells of more."""

    question: str
    sql: str
    columns: list[str]
    results: list[dict]
    row_count: int
    truncated: bool


def register_views(marts: dict[str, DataFrame]) -> None:
    for name, df in marts.items():
        df.createOrReplaceTempView(name)


def reading_query(spark: SparkSession, sql: str, readable: Collection[str] = READABLE) -> DataFrame:
    """The query as a frame, once its parsed tree is known to only read ``readable`` relations (``guard``).

    Files by path, other tables, functions that make rows, functions that
    tell of the session or call into the JVM, and anything that writes are
    refused; a name of WITH counts where it is in scope and nowhere else.
    """
    text = sql.strip().rstrip(";")
    words = text.split(maxsplit=1)
    if not words:
        raise Refused("the query must not be empty")
    if words[0].lower() not in ("select", "with"):
        raise Refused("only SELECT queries are run")
    require_readable(spark, text, readable)
    return spark.sql(text)


def select(spark: SparkSession, sql: str, cap: int = RESULT_CAP, readable: Collection[str] = READABLE) -> DataFrame:
    """The query's first ``cap`` rows, still to be run."""
    return reading_query(spark, sql, readable).limit(cap)


def answer(
    spark: SparkSession, sql: str, question: str = "", cap: int = RESULT_CAP, readable: Collection[str] = READABLE
) -> Answer:
    """Run a query and return at most ``cap`` rows; one more tells of the rest."""
    df = reading_query(spark, sql, readable)
    rows = [row.asDict() for row in df.limit(cap + 1).collect()]
    kept = rows[:cap]
    return Answer(question, sql, df.columns, kept, len(kept), len(rows) > cap)


def answer_frame(spark: SparkSession, found: Answer, schema) -> DataFrame:
    """An answer as rows: its results, next to the columns, the number of rows and whether more were left."""
    rows = spark.createDataFrame([tuple(r[c] for c in found.columns) for r in found.results], schema)
    return rows.select(
        "*",
        F.lit(",".join(found.columns)).alias("column_names"),
        F.lit(found.row_count).alias("row_count"),
        F.lit(found.truncated).alias("truncated"),
    )


def catalog_columns(schemas: dict[str, T.StructType]) -> list[tuple[str, str, str, int]]:
    """What may be queried: table, column, type and position, off the schemas alone."""
    return [
        (name, field.name, field.dataType.simpleString(), position)
        for name, schema in schemas.items()
        for position, field in enumerate(schema.fields, start=1)
    ]


def catalog(marts: dict[str, DataFrame]) -> DataFrame:
    """The catalog with how many values each column holds, which reads the marts."""

    def described(name: str, df: DataFrame) -> DataFrame:
        columns = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.lit(position).alias("position"),
                F.count(field.name).alias("n_values"),
            )
            for position, field in enumerate(df.schema.fields, start=1)
        ]
        return df.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))

    return reduce(DataFrame.unionByName, [described(name, df) for name, df in marts.items()])
