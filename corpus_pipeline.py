"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and hands the re-read table to the next stage. All stages but
the last return the columns of ``documents``, whatever further columns there
are. What a stage keeps on the way is deleted when its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import decontaminate, language, near_dedup, packing, suffix_dedup
from panelloom.llm.registry import importable, table
from panelloom.session import fresh_path, scratch_scope

SHINGLE_WORDS = 5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; narrow margins and texts without a letter go."""
    importable(spark)
    rows = docs.select(F.struct("*").alias("row")).select("row", "row.text")
    return language.identify(rows, language.fit(docs)).where("not rejected").select("row.*")


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    importable(spark)
    return near_dedup.without_near_duplicates(docs, SHINGLE_WORDS)


def _with_text_left(docs: DataFrame, columns: list[str]) -> DataFrame:
    counted = docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in columns else docs
    return counted.where(F.trim("text") != "").select(*[f"`{c}`" for c in columns])


def passage_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; emptied documents go."""
    importable(spark)
    return _with_text_left(suffix_dedup.without_repeats(docs), docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; emptied documents go."""
    return _with_text_left(decontaminate.without_spans(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    importable(spark)
    return packing.pack_pieces(packing.token_pieces(docs, *packing.public_vocabulary()))


STAGES = [
    ("language_id", identified),
    ("near_dedup", near_deduplicated),
    ("suffix_dedup", passage_deduplicated),
    ("decontamination", decontaminated),
    ("packing", packed),
]

ORACLE_SQL = None  # tested against a version in plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), fresh_path(spark, "result")
    with scratch_scope(spark):
        for name, stage in STAGES:
            path = last if name == STAGES[-1][0] else fresh_path(spark, name)
            with scratch_scope(spark):
                found = stage(spark, docs, sf_dir)
                found.write.parquet(path)
            docs = spark.read.schema(found.schema).parquet(path)
    return docs
