"""An archive that tells whether it is whole, before a table is replaced."""

from __future__ import annotations

import shutil
import uuid
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelloom.plans.weekly import load_all
from panelloom.sinks import tables
from panelloom.sources.snapshots import Incomplete, read_snapshot, verified_snapshot

D1, AT = date(2026, 1, 5), datetime(2026, 1, 5, 22)


@pytest.fixture
def cells(spark):
    head = "array('Key', 'Value')"
    return spark.range(3_000).selectExpr(
        "concat('f', id % 3) as file", "'Data' as sheet", "0 as sheet_pos", "cast(floor(id / 3) as int) as row_idx",
        f"if(id < 3, {head}, array(cast(id as string), null)) as cells", "'fund_quarterly' as dataset",
    )


@pytest.fixture
def loaded(spark, cells, tmp_path):
    """An archive, a schema with its table of 2,997 rows, and a way to load it again."""
    root, schema = str(tmp_path), f"loom_{uuid.uuid4().hex}"
    tables.archive(cells.repartition(4), root, D1)
    tables.create_schema(spark, schema)
    load = lambda: load_all(spark, root, D1, AT, schema, ["fund_quarterly"])
    assert load() == {f"{schema}.fund_quarterly": 2_997}
    return root, spark.table(f"{schema}.fund_quarterly"), load


def files(root):
    return sorted(Path(f"{root}/run_date=2026-01-05/dataset=fund_quarterly").glob("*.parquet"))


def test_a_removed_file_raises_before_the_table_changes(loaded):
    root, table, load = loaded
    files(root)[0].unlink()
    with pytest.raises(Incomplete, match="differs"):
        load()
    assert table.count() == 2_997


def test_a_file_twice_raises(loaded):
    root, _, load = loaded
    shutil.copy(files(root)[0], files(root)[0].with_name("part-again.parquet"))
    with pytest.raises(Incomplete):
        load()


def test_a_half_written_date_raises(spark, cells, loaded):
    """The same number of rows, but one cell another; and a date whose manifest was never reached."""
    root, _, load = loaded
    changed = cells.withColumn("cells", F.when(F.col("row_idx") == 500, F.array(F.lit("x"), F.lit(None))).otherwise(F.col("cells")))
    changed.drop("dataset").write.mode("overwrite").parquet(f"{root}/run_date=2026-01-05/dataset=fund_quarterly")
    with pytest.raises(Incomplete):
        load()
    cells.write.partitionBy("dataset").parquet(f"{root}/run_date=2026-01-12")
    assert read_snapshot(spark, root, date(2026, 1, 12)).count() == 3_000
    with pytest.raises(Incomplete, match="no manifest"):
        verified_snapshot(spark, root, date(2026, 1, 12), "fund_quarterly")


def test_loading_a_date_again_keeps_the_other_manifests(spark, cells, loaded):
    root, _, load = loaded
    tables.archive(cells.withColumn("dataset", F.lit("annual_bulletin")).where("row_idx < 10"), root, D1)
    assert verified_snapshot(spark, root, D1, "annual_bulletin")[0].count() == 30
    tables.archive(cells.where("row_idx < 100"), root, D1)
    load()
    assert verified_snapshot(spark, root, D1, "fund_quarterly")[0].count() == 300
    assert verified_snapshot(spark, root, D1, "annual_bulletin")[1].count() == 3
