"""Documents seen as sheets: a document is a sheet, a line a row, a word a cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.standins.tables import table


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is a workbook; two blanks in a row leave an empty cell."""
    return (
        table(spark, sf_dir, "documents")
        .select(
            F.col("source").alias("file"),
            F.col("doc_id").cast("string").alias("sheet"),
            F.col("doc_id").alias("sheet_pos"),
            F.posexplode(F.split("text", "\n")).alias("row_idx", "line"),
        )
        .withColumn("cells", F.transform(F.split("line", " "), lambda word: F.nullif(word, F.lit(""))))
        .drop("line")
    )


def language_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a source as sheets named after their language."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("file"),
        F.concat(F.lit(" "), F.upper("lang"), F.lit(" ")).alias("sheet"),
        F.col("doc_id").alias("sheet_pos"),
    )


CELLS_SQL = """
sheet_lines as (
  select source, doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as row_idx
  from documents
),
cells as (
  select source as file, cast(doc_id as varchar) as sheet, row_idx,
         list_transform(string_split(line, ' '), lambda w: nullif(w, '')) as cells
  from sheet_lines
)
"""
