"""What keeps hot groups out of single tasks, seen on skewed data."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import panelloom.session as session
from panelloom.operators.ordered import CHUNK, cut_in_order
from panelloom.operators.ranking import Ranking, with_rankings
from panelloom.plans.questions import top_by_type
from panelloom.sinks.tables import archive, latest_per_key
from panelloom.sources.sheets import chosen_sheets, clean_names, header_names, sheet_table


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 rows, a third of them in one group and a third with one value."""
    return spark.range(60_000).selectExpr(
        "id", "if(id % 3 = 0, 'hot', concat('g', id % 500)) as grp", "if(id % 3 = 1, 0.5, (id * 7919 % 10007) / 1000) as value"
    )


def sizes(cut):
    return [r["count"] for r in cut.groupBy(CHUNK).count().collect()]


def test_chunks_are_even_although_groups_are_not(hot):
    found = sizes(cut_in_order(hot, [F.asc("grp"), F.asc("id")], 16))
    assert len(found) == 16 and sum(found) == 60_000
    assert max(found) < 3 * 60_000 / 16


def test_a_chunk_number_is_stable_between_reads(hot):
    cut = cut_in_order(hot, [F.asc("grp"), F.asc("id")], 16)
    again = cut.select("id", F.col(CHUNK).alias("other"))
    assert cut.join(again, "id").where(F.col(CHUNK) != F.col("other")).count() == 0


def test_equal_values_are_counted_before_they_are_ordered(hot, monkeypatch):
    import panelloom.operators.ordered as ordered

    written = []
    original = ordered.write_through

    def spy(df, label):
        table = original(df, label)
        written.append(table)
        return table

    monkeypatch.setattr(ordered, "write_through", spy)
    with_rankings(hot, [Ranking(("grp",), "value", rank="r")], 8)
    (counts,) = written
    assert counts.where("grp = 'hot'").count() == hot.where("grp = 'hot'").select("value").distinct().count()
    assert counts.agg(F.sum("_n")).collect()[0][0] == 60_000


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_reduced_before_the_shuffle(hot):
    plan = plan_of(latest_per_key(hot, ["grp"], ["id"]))
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")
    panel = hot.selectExpr(
        "grp as fund_type", "value as return_5yr", "id as abn", "grp as product_name", "date'2020-03-31' as quarter_date"
    )
    limits = plan_of(top_by_type(panel))
    assert limits.count("WindowGroupLimit") == 2 and "Partial" in limits


def test_a_rank_join_splits_a_hot_value(spark, hot):
    """With no broadcast allowed, adaptive execution splits the hot value's rows."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    rows = hot.withColumn("payload", F.sha2(F.col("id").cast("string"), 512)).repartition(16)
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ranked = with_rankings(rows, [Ranking((), "value", rank="r")])
        assert ranked.select(F.countDistinct("id"), F.max("payload"), F.max("r")).collect()[0][0] == 60_000
        ranked.collect()
        assert "skew=true" in plan_of(ranked)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_archived_sheets_prune_dates_and_sort_rows(spark, tmp_path):
    from datetime import date

    cells = spark.range(1000).selectExpr(
        "'f' as file", "concat('s', id % 3) as sheet", "0 as sheet_pos", "cast(id as int) as row_idx",
        "array('x') as cells", "'k' as dataset",
    )
    archive(cells.repartition(1), str(tmp_path), date(2026, 1, 5))
    stored = spark.read.parquet(str(tmp_path)).select("sheet", "row_idx").collect()
    assert [tuple(r) for r in stored] == sorted(tuple(r) for r in stored)


def test_one_huge_sheet_among_small_ones(spark):
    """20,000 rows on one sheet and two on others: every row finds its columns."""
    rows = spark.range(20_000).selectExpr(
        "'big' as file", "'Data' as sheet", "0 as sheet_pos", "cast(id + 1 as int) as row_idx",
        "array(cast(id as string), 'v') as cells",
    )
    small = spark.createDataFrame(
        [("big", "Data", 0, 0, ["key", "value"]), ("low", "Data", 0, 0, ["value", "key"]), ("low", "Data", 0, 1, ["v", "k"])],
        rows.schema,
    )
    cells = rows.unionByName(small)
    assert chosen_sheets(cells).count() == 2
    table = sheet_table(cells, clean_names(header_names(cells, 0)), ["key", "value"])
    assert table.where("value = 'v'").count() == 20_001
    assert table.select("key").distinct().count() == 20_001


def test_a_cluster_must_name_a_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", applicationId="app", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_folder(cluster)
    cluster.conf.get = lambda key, default: "hdfs://shared/scratch/"
    assert session.scratch_folder(cluster) == "hdfs://shared/scratch/panelloom-app"
