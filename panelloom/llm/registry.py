"""The queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = [
    "near_dedup",
    "suffix_dedup",
    "packing",
    "decontaminate",
    "cap_filters",
    "language",
    "toxicity",
    "url_rules",
    "warc",
    "preference",
    "conversation_repair",
    "pu_quality",
    "filter_audit",
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, and keep the batches they get small.

    A cluster gets the package with --py-files. Texts may be long, so a batch
    has fewer rows than Spark's default of 10,000.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def load_queries() -> None:
    for module in MODULES:
        importlib.import_module(f"panelloom.llm.{module}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
