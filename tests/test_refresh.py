"""Runs that rebuild what has changed and nothing else, and equal a run from scratch."""

from __future__ import annotations

import random
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from panelloom.operators import checks
from panelloom.plans import marts, refresh
from panelloom.sinks import tables, versions

Q = [date(2020 + k // 4, 3 * (k % 4) + 1, 1) for k in range(14)]
SCHEMA = (
    "fund_name string, abn string, product_name string, quarter_date date, return_1yr decimal(10,6), return_3yr decimal(10,6), "
    "return_5yr decimal(10,6), total_fee_pct decimal(10,6), net_assets_m decimal(18,2), member_accounts bigint, fund_type string, _loaded_at string"
)


def staged_rows(seed=1):
    """Twelve funds with gaps, in fourteen quarters; members are missing here and there."""
    rnd, rows = random.Random(seed), {}
    for fund in range(12):
        for q in Q:
            if rnd.random() < 0.3:
                continue
            members = None if rnd.random() < 0.1 else rnd.randrange(100, 999)
            assets = rnd.randrange(1000)
            for product in "xy"[: rnd.randrange(1, 3)]:
                rows[fund, q, product] = [rnd.randrange(99), rnd.randrange(99), rnd.choice([None, 1, 2, 3]), rnd.randrange(5), assets, members]
    return rows


def frame(spark, rows, loaded="then"):
    data = []
    for (fund, q, product), (r1, r3, r5, fee, assets, members) in rows.items():
        rate = lambda v: None if v is None else v / 100
        data.append((f"fund {fund}", str(fund), product, q, rate(r1), rate(r3), rate(r5), rate(fee), float(assets), members, "retail", loaded))
    names = [f.split()[0] for f in SCHEMA.replace("decimal(10,6)", "d").replace("decimal(18,2)", "d").split(", ")]
    kinds = SCHEMA.replace("decimal(10,6)", "double").replace("decimal(18,2)", "double")
    raw = spark.createDataFrame(data, kinds)
    typed = {c: F.col(c).cast("decimal(10,6)") for c in names if c.startswith("return") or c == "total_fee_pct"}
    return raw.withColumns({**typed, "net_assets_m": F.col("net_assets_m").cast("decimal(18,2)")})


@pytest.fixture
def schema(spark):
    name = f"loom_{uuid.uuid4().hex}"
    tables.create_schema(spark, name)
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def run(spark, schema, staged):
    """Rows written by mart, after which the marts must equal those built from scratch."""
    staged = staged.cache()
    written, results, keep = refresh.refresh_marts(staged, schema)
    checks.gate([row for found in results for row in found()])
    keep()
    for name, build in marts.MARTS.items():
        text = lambda df: sorted(str(tuple(r)) for r in df.collect())
        assert text(spark.table(f"{schema}.{name}")) == text(build(staged)), name
    staged.unpersist()
    return {name.split(".")[1]: n for name, n in written.items()}


def generations(spark, schema):
    return {name: versions.versions_of(spark, f"{schema}.{name}").held for name in marts.MARTS}


def test_the_same_data_again_writes_nothing(spark, schema):
    rows = staged_rows()
    first = run(spark, schema, frame(spark, rows))
    assert all(first.values())
    before = generations(spark, schema)
    again = run(spark, schema, frame(spark, dict(reversed(rows.items())), loaded="now").repartition(7))
    assert again == {"fund_performance": 0, "fee_vs_return": 0, "member_flow": 0} and generations(spark, schema) == before


@pytest.mark.parametrize("change", ["gone", "fund_gone", "new", "quarter_gone", "newest_gone", "members"])
def test_a_late_change_rebuilds_what_it_reaches(spark, schema, change):
    rows = staged_rows(3)
    run(spark, schema, frame(spark, rows))
    before = generations(spark, schema)
    late = Q[6]
    some = next(k for k in rows if k[1] == late and rows[k][5] is not None and rows[k][2] is not None)
    if change == "members":
        for k in rows:
            if k[:2] == some[:2]:
                rows[k][5] += 1
    elif change == "gone":
        rows = {k: v for k, v in rows.items() if k[:2] != some[:2]}
    elif change == "fund_gone":
        rows = {k: v for k, v in rows.items() if k[0] != some[0] or k[1] < Q[3]}
    elif change == "new":
        fund = next(f for f in range(12) if not any(k[:2] == (f, late) for k in rows))
        rows[fund, late, "x"] = [1, 1, 1, 1, 1, 7]
    else:
        rows = {k: v for k, v in rows.items() if k[1] != (late if change == "quarter_gone" else Q[-1])}
    reaches_newest = change == "newest_gone" or (change == "fund_gone" and some[0] in {k[0] for k in staged_rows(3) if k[1] == Q[-1]})
    run(spark, schema, frame(spark, rows))
    after = generations(spark, schema)
    (old,) = before["fund_performance"]
    kept = set(after["fund_performance"].get(old, []))
    if change != "fund_gone":
        assert set(before["fund_performance"][old]) - kept == {str(Q[-1] if change == "newest_gone" else late)}
    assert (after["fee_vs_return"] == before["fee_vs_return"]) == (not reaches_newest)
    (old,) = before["member_flow"]
    rebuilt = set(before["member_flow"][old]) - set(after["member_flow"].get(old, []))
    assert rebuilt and (change == "fund_gone" or min(rebuilt) >= str(Q[-1] if change == "newest_gone" else late))
    assert len(rebuilt) < len(Q)


def test_a_run_that_stops_is_made_up_for(spark, schema, monkeypatch):
    """Checks fail after the marts are built: the quarters still count as changed."""
    rows = staged_rows(5)
    run(spark, schema, frame(spark, rows))
    next(v for k, v in rows.items() if k[1] == Q[2])[3] = 77
    refresh.refresh_marts(frame(spark, rows), schema)  # nothing is kept
    assert run(spark, schema, frame(spark, rows))["fund_performance"] > 0
    monkeypatch.setattr(refresh, "BUILT_AS", 2)
    assert run(spark, schema, frame(spark, rows))["member_flow"] == spark.table(f"{schema}.member_flow").count()


def test_newest_quarter_of_a_stored_mart(spark, schema):
    run(spark, schema, frame(spark, staged_rows()))
    last = refresh.newest_mart_rows(spark, f"{schema}.fund_performance")
    assert {r.quarter_date for r in last.collect()} == {Q[-1]}
    assert last.count() == spark.table(f"{schema}.fund_performance").where(F.col("quarter_date") == Q[-1]).count()


def test_checks_of_a_grain_in_one_read(spark, rows):
    data = [(1, 1, "a", 5, "x"), (1, 1, "a", 5, "x"), (1, 1, "b", 6, None), (1, 2, "a", None, "y"), (1, 2, "b", 3, "z"), (2, 1, None, 1, "x"), (2, 1, None, 1, "x")]
    df = spark.createDataFrame(data, "k int, q int, p string, total int, kind string")
    wanted = dict(not_null=["p", "total"], accepted={"kind": ["x", "y"]}, row_count=(1, 6))
    found = checks.grain_checks(df, "t", ["k", "q"], ["p"], ["total"], **wanted)
    plain = checks.report(
        checks.row_checks(df, "t", **wanted),
        checks.as_result(checks.duplicates(df, ["k", "q", "p"]), "t", "k, q, p", "unique"),
        checks.as_result(checks.grain_conflicts(df, ["k", "q"], ["total"]), "t", "k, q", "one_total"),
    )
    assert rows(found) == rows(plain) and rows(found)[-1][3] == 1
    empty = checks.grain_checks(df.where("false"), "t", ["k", "q"], ["p"], ["total"], row_count=(1, None))
    assert [r.failures for r in empty.orderBy("check_name").collect()] == [0, 1, 0]
    counted, results = checks.watched(df, "t", not_null=["p"], accepted={"kind": ["x"]})
    counted.write.format("noop").mode("overwrite").save()
    assert [(r["check_name"], r["failures"]) for r in results()] == [("not_null", 2), ("accepted_values", 2)]
