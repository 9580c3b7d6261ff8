"""Refused values: found in the scan that stages the rest, with row, column, text and reason."""

from __future__ import annotations

import uuid
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom.plans.staging import RATES, parsed, quarantine, staged_rows, staging, unstaged
from panelloom.plans.weekly import weekly_run
from panelloom.session import fresh_path, write_through
from panelloom.standins.workbooks import landed

D1, AT = date(2026, 1, 5), datetime(2026, 1, 5, 22)
COLUMNS = ["abn", "fund_name", "product_name", "quarter_year", *RATES, "net_assets_m", "member_accounts", "fund_type"]
GOOD = {"abn": "1", "fund_name": " Fund ", "product_name": "p", "quarter_year": "2020-12-31 00:00:00", "fund_type": " Retail "}


def raw(spark, *rows):
    data = [tuple({**GOOD, **row}.get(c) for c in COLUMNS) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))


def refused(df):
    return sorted((r["abn"], r["column"], r["text"], r["reason"]) for r in quarantine(parsed(df)).collect())


def test_reasons(spark):
    rows = raw(
        spark,
        {"return_1yr": "n/a", "return_3yr": "10000", "return_5yr": "1e-3", "total_fee_pct": " 0.5 "},
        {"abn": "2", "net_assets_m": "1e16", "member_accounts": "12.5"},
        {"abn": "3", "net_assets_m": "-", "member_accounts": "1e30", "return_1yr": "NaN", "return_3yr": "Infinity"},
        {"abn": "4", "member_accounts": "9223372036854775807", "admin_fee_pct": ""},
        {"abn": "5", "member_accounts": "9223372036854775807.5"},
    )
    assert refused(rows) == [
        ("1", "return_1yr", "n/a", "not a number"),
        ("1", "return_3yr", "10000", "out of range"),
        ("2", "net_assets_m", "1e16", "out of range"),
        ("3", "member_accounts", "1e30", "out of range"),
        ("3", "net_assets_m", "-", "not a number"),
        ("3", "return_1yr", "NaN", "not a number"),
        ("3", "return_3yr", "Infinity", "not a number"),
        ("4", "admin_fee_pct", "", "not a number"),
        ("5", "member_accounts", "9223372036854775807.5", "out of range"),
    ]


def test_rows_left_out_are_named(spark):
    rows = raw(
        spark,
        {"abn": "1", "fund_name": None},
        {"abn": "2", "quarter_year": None},
        {"abn": "3", "quarter_year": "Q4", "fund_name": None},
        {"abn": None, "quarter_year": "Q4"},
    )
    found = quarantine(parsed(rows)).collect()
    assert sorted(((r["abn"], r["column"], r["text"], r["reason"]) for r in found), key=repr) == [
        ("1", "fund_name", None, "missing"),
        ("2", "quarter_year", None, "missing"),
        ("3", "fund_name", None, "missing"),
        ("3", "quarter_year", "Q4", "not a date"),
        (None, "quarter_year", "Q4", "not a date"),
    ]
    assert staged_rows(parsed(rows)).count() == 1


def test_staged_rows_are_those_of_lenient_staging(spark):
    rows = raw(
        spark,
        {"return_1yr": "n/a", "net_assets_m": "1.005", "member_accounts": "2.5"},
        {"return_1yr": "n/a", "net_assets_m": "1.005", "member_accounts": "2.5"},
        {"abn": "2", "member_accounts": "1e30"},
        {"abn": "3", "fund_name": None},
        {"abn": "4", "quarter_year": "never"},
    ).withColumn("_run_date", F.lit("then"))
    lenient, kept = staging(rows, strict=False), staged_rows(parsed(rows))
    assert kept.schema.simpleString() == lenient.schema.simpleString()
    assert sorted(kept.collect(), key=repr) == sorted(lenient.collect(), key=repr) and kept.count() == 4
    first = kept.where("abn = '1'").first()
    assert (first["fund_name"], first["return_1yr"], first["net_assets_m"], first["member_accounts"]) == ("Fund", None, Decimal("1.01"), 3)
    assert sorted(r["abn"] for r in unstaged(rows).collect()) == ["1", "1", "2", "4"]
    with pytest.raises(PySparkException):
        staging(rows.where("abn = '2'")).collect()


def test_typed_columns_and_empty_input(spark):
    typed = raw(spark, {}).withColumns(
        {
            "quarter_year": F.lit(date(2020, 12, 31)),
            "net_assets_m": F.lit(1e20),
            "member_accounts": F.lit(7).cast("bigint"),
            "return_1yr": F.lit(float("nan")),
        }
    )
    assert refused(typed) == [("1", "net_assets_m", "1.0E20", "out of range"), ("1", "return_1yr", "NaN", "not a number")]
    assert refused(typed.limit(0)) == [] and staged_rows(parsed(typed.limit(0))).count() == 0


def test_staged_and_refused_come_out_of_one_scan(spark):
    source = write_through(raw(spark, {"return_1yr": "n/a"}, {"abn": "2"}), "raw")
    rows = write_through(parsed(source), "parsed")
    plan = parsed(source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    for df in (staged_rows(rows), quarantine(rows)):
        assert set(df.inputFiles()) <= set(rows.inputFiles())


def test_run_lists_what_it_refused(spark):
    root, raw_schema, mart = fresh_path(spark, "archive"), *[f"loom_{uuid.uuid4().hex}" for _ in range(2)]
    cells = write_through(landed(spark, "/root/testdata/sf0.001"), "landed")
    fee = F.transform("cells", lambda c: F.when(c.rlike(r"^0\.\d{6}5$"), F.concat(c, F.lit("?"))).otherwise(c))
    broken = cells.withColumn("cells", F.when(F.col("row_idx") % 40 == 20, fee).otherwise(F.col("cells")))
    name = f"{raw_schema}.quarantine"
    types = [r["t"] for r in spark.read.parquet("/root/testdata/sf0.001/region.parquet").select(F.lower(F.trim("r_name")).alias("t")).collect()]
    with pytest.raises(PySparkException):
        weekly_run(spark, broken, root, D1, AT, raw_schema, mart, types)
    run = weekly_run(spark, broken, root, D1, AT, raw_schema, mart, types, quarantine=name)
    found = spark.table(name).collect()
    assert run.rows[name] == len(found) > 0
    assert all(r["text"].endswith("?") and r["reason"] == "not a number" and r["abn"] and r["quarter_year"] for r in found)
    staged, performance = spark.table("staging"), f"{mart}.fund_performance"
    lost = Counter((r["abn"], r["product_name"], r["quarter_year"][:10]) for r in found if r["column"] == "return_5yr")
    null = staged.where("return_5yr is null").select("abn", "product_name", F.col("quarter_date").cast("string")).collect()
    assert lost and not lost - Counter(map(tuple, null))
    assert spark.table(performance).count() == staged.where("return_5yr is not null").count()
    assert weekly_run(spark, cells, root, D1, AT, raw_schema, mart, types, quarantine=name).rows[name] == 0
    assert spark.table(name).count() == 0
    assert spark.table(performance).count() == spark.table("staging").where("return_5yr is not null").count()
