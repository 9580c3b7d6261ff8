"""Where a job keeps the intermediate tables it reads more than once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

_scopes: list[list[str]] = []


def scratch_folder(spark: SparkSession) -> str:
    """The application's folder inside the shared folder the cluster names.

    ``spark.checkpoint.dir`` decides. Only a local master, where driver and
    executors are one machine, may fall back to the warehouse.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/panelloom-{sc.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that no earlier call has returned."""
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends, also by an error."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def seen_by(observation: Observation, of_none: dict) -> dict:
    """What an observation counted; ``of_none`` where the engine found that there were no rows, and so nothing to observe."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return of_none


def write_through(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and go on from the written table.

    Used where a result feeds several branches: it is computed once, later
    reads prune its columns, and a lost executor re-reads files instead of
    recomputing the lineage. With ``partition`` the table is laid out by that
    column, a large partition split over several files, so that a filter on
    it leaves the others unread.
    """
    path = fresh_path(df.sparkSession, label)
    if partition:
        df.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def release_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate tables, once nothing reads them."""
    _delete(spark, scratch_folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
