"""Chunked computations equal plain windows, however the rows are cut."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.operators.flow import previous_values, row_flow
from panelloom.operators.ordered import running_total, with_lookback
from panelloom.operators.ranking import Ranking, exact_medians, with_rankings

CHUNKS = [None, 1, 3, 11]


@pytest.fixture(scope="module")
def skewed(spark):
    """400 rows, a third of them in one group, many ties, nulls in key and value."""
    pick = random.Random(7)
    groups = ["hot"] * 6 + ["a", "b", None, "c", "d", "e", "f", "g", "h", "i", "j", "k"]
    data = [
        (i, pick.choice(groups), pick.choice([None, 0.0, 0.0, 1.5, 2.5, 3.25, -1.0]), pick.randint(0, 50))
        for i in range(400)
    ]
    return spark.createDataFrame(data, "id int, grp string, value double, n int").cache()


@pytest.mark.parametrize("chunks", CHUNKS)
def test_rankings_equal_windows(skewed, rows, chunks):
    by_group = Ranking(("grp",), "value", descending=True, rank="r")
    overall = Ranking((), "value", descending=True, rank="o")
    share = Ranking(("grp",), "value", percent_rank="p", peers="c")
    group, everyone = Window.partitionBy("grp"), Window.partitionBy(F.lit(0))
    expected = skewed.select(
        "id",
        F.rank().over(group.orderBy(F.desc_nulls_last("value"))).cast("bigint").alias("r"),
        F.rank().over(everyone.orderBy(F.desc_nulls_last("value"))).cast("bigint").alias("o"),
        F.percent_rank().over(group.orderBy(F.asc_nulls_last("value"))).alias("p"),
        F.count("*").over(group).alias("c"),
    )
    found = with_rankings(skewed, [by_group, overall, share], chunks)
    assert rows(found, "id", "r", "o", "p", "c") == rows(expected)


@pytest.mark.parametrize("chunks", CHUNKS)
def test_running_total_equals_window(skewed, rows, chunks):
    group = Window.partitionBy("grp")
    before = group.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    expected = skewed.select(
        "id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("b"), F.sum("n").over(group).alias("t")
    )
    found = running_total(skewed.select("id", "grp", "n"), ["grp"], [F.asc("id")], "n", "b", "t", chunks)
    assert rows(found, "id", "b", "t") == rows(expected)


@pytest.mark.parametrize("chunks", [None, 2, 40, 150])
@pytest.mark.parametrize("back", [1, 4])
def test_lookback_equals_window(skewed, rows, chunks, back):
    """Up to 150 chunks of few rows: the rows before lie several chunks away."""

    def add(frame, window):
        return frame.withColumns(
            {"lag": F.lag("n", back).over(window), "sum": F.sum("n").over(window.rowsBetween(-back, 0))}
        )

    expected = add(skewed, Window.partitionBy("grp").orderBy("id"))
    found = with_lookback(skewed, ["grp"], ["id"], back, add, chunks)
    assert rows(found, "id", "lag", "sum") == rows(expected, "id", "lag", "sum")


@pytest.mark.parametrize("chunks", [None, 25])
def test_previous_values_keep_rows_and_nulls(skewed, rows, chunks):
    found = previous_values(skewed, "grp", ["id"], {"value": "before"}, chunks)
    expected = skewed.withColumn("before", F.lag("value").over(Window.partitionBy("grp").orderBy("id")))
    assert rows(found, "id", "before") == rows(expected, "id", "before")


@pytest.mark.parametrize("chunks", [None, 2, 60])
def test_row_flow_rolls_over_chunk_edges(skewed, chunks, rows):
    data = skewed.where("grp is not null").select("id", "grp", F.col("n").cast("bigint").alias("n"), "value")
    found = row_flow(data, "grp", ["id"], "n", "value", chunks)
    window = Window.partitionBy("grp").orderBy("id")
    change = data.withColumn("before", F.lag("n").over(window)).where("before is not null")
    rolled = change.withColumn("d", F.col("n") - F.col("before")).withColumn(
        "roll", F.sum("d").over(window.rowsBetween(-3, 0))
    )
    assert rows(found, "id", "member_net_change", "rolling_annual_member_change") == rows(rolled, "id", "d", "roll")


@pytest.mark.parametrize("chunks", CHUNKS)
def test_exact_medians(skewed, chunks):
    values = sorted(r["value"] for r in skewed.collect() if r["value"] is not None)
    counts = sorted(r["n"] for r in skewed.collect())

    def median(x):
        low, high = x[(len(x) - 1) // 2], x[len(x) // 2]
        return low + (high - low) / 2

    found = exact_medians(skewed, {"value": "v", "n": "n"}, chunks).collect()[0]
    assert (found["v"], found["n"]) == (median(values), median(counts))


def test_median_of_even_number_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None), (2.0, None), (10.0, None)], "x double, y double")
    found = exact_medians(df, {"x": "x", "y": "y"}).collect()[0]
    assert (found["x"], found["y"]) == (3.0, None)


def test_infinities_and_signed_zero_rank(spark, rows):
    data = [(1, 0.0), (2, -0.0), (3, float("inf")), (4, float("-inf")), (5, 1.0)]
    df = spark.createDataFrame(data, "id int, x double")
    ranked = with_rankings(df, [Ranking((), "x", descending=True, rank="r")], 3)
    assert rows(ranked, "id", "r") == [(1, 3), (2, 3), (3, 1), (4, 5), (5, 2)]
