"""What questions may name: names of WITH by scope, relations by identity, functions by list."""

from __future__ import annotations

import uuid

import pytest

from panelloom.plans import guard, selects
from panelloom.plans.guard import Refused
from panelloom.sinks import tables

REFUSED = [
    # a name of WITH is no name for the same table inside it, beside it or behind dots
    "with secret as (select * from secret) select * from secret",
    "select s.* from secret s, (with secret as (select 1 a) select * from secret) x",
    "with `raw.hidden` as (select 1) select * from raw.hidden",
    "with a as (select * from b), b as (select 1 x) select * from a",
    "with a as (with secret as (select 1 x) select * from secret) select * from a, secret",
    "select * from (with m as (select 1 x) select * from m) q where x in (select x from m)",
    "with m as (select 1 x) select * from `mart.member_flow`",
    "select * from member_flow where exists (with secret as (select 2 id) select 1) and abn in (select id from secret)",
    "with recursive r as (select abn from member_flow union all select abn + 1 from r) select * from r",
    # subqueries wherever an expression may stand
    "select * from member_flow, lateral (select * from secret) s",
    "select case when abn > 1 then (select max(id) from secret) end from member_flow",
    "select abn from member_flow group by abn having count(*) > (select count(*) from secret)",
    "select abn from member_flow order by (select max(id) from secret)",
    "select sum(abn) over w from member_flow window w as (order by (select max(id) from secret))",
    "select sum(abn) filter (where abn in (select id from secret)) from member_flow",
    "select transform(array(1), x -> x + (select max(id) from secret)) from member_flow",
    "select * from member_flow union all select id from secret",
    "select * from member_flow join secret on true",
    "select * from (select * from (select * from `SECRET`))",
    "select * from /* member_flow */ secret -- member_flow",
    # other sources
    "select * from parquet.`/etc`",
    "select * from range(3)",
    "select * from values (1), (2)",
    "select * from identifier('secret')",
    "select * from member_flow version as of 1",
    "select explode(sequence(1, 1000000000)) from member_flow",
    "select * from member_flow lateral view explode(array(1)) t",
    "select * from member_flow tablesample (10 percent)",
    "select * from spark_catalog.mart.secret",
    # functions
    "select reflect/**/('java.lang.System', 'getProperty', 'java.version') from member_flow",
    "select builtin.reflect('java.lang.System', 'nanoTime') from member_flow",
    "select `java_method`('java.lang.System', 'nanoTime') from member_flow",
    "select current_user() from member_flow",
    "select current_user from member_flow",
    "select input_file_name() from member_flow",
    "select _metadata.file_path from member_flow",
    "select member_flow._metadata.file_path from member_flow",
    "select current_database(), version() from member_flow",
    "select identifier('abn') from member_flow",
    "select my_own(abn) from member_flow",
    "select abn from member_flow where abn = ?",
    # no query
    "select 1; select 2",
    "select 1) union (select 2",
    "with a as (select 1 x) insert into member_flow select * from a",
    "with a as (select 1 x) from a insert into member_flow select *",
    "select transform(abn) using 'cat' from member_flow",
]


@pytest.fixture(autouse=True)
def tables_there(spark):
    spark.range(3).createOrReplaceTempView("secret")
    spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "abn int, fund_name string, total_fee_pct double").createOrReplaceTempView("member_flow")


@pytest.mark.parametrize("text", REFUSED)
def test_refused(spark, text):
    with pytest.raises(Refused):
        selects.answer(spark, text)


RUN = {
    "with secret as (select abn from member_flow) select * from secret": [(1,), (2,)],
    "with a as (select abn x from member_flow), b as (select x from a) select a.x from a join b using (x)": [(1,), (2,)],
    "with a as (with a as (select 7 x) select * from a) select * from a": [(7,)],
    "select abn from member_flow where abn in (with m as (select max(abn) b from Member_Flow) select b from m)": [(2,)],
    "select m.abn, l.c from member_flow m, lateral (select count(*) c from member_flow f where f.abn <= m.abn) l": [(1, 1), (2, 2)],
    "select abn, row_number() over w from member_flow window w as (order by abn desc)": [(1, 2), (2, 1)],
    "select abn, rank() over (order by total_fee_pct desc nulls last) from member_flow": [(1, 1), (2, 2)],
    "select count(*), sum(abn) filter (where abn > 1), max(coalesce(total_fee_pct, 0.0)) from member_flow": [(2, 2, 2.5)],
    "select upper(fund_name) n from member_flow where fund_name like 'a%' or fund_name rlike 'b' order by 1 limit 1": [("A",)],
    "select case when abn between 1 and 1 then 'x' else 'y' end k from member_flow group by all having count(*) >= 1": [("x",), ("y",)],
    "select percentile_cont(0.5) within group (order by abn) from member_flow": [(1.5,)],
    "select abn from member_flow except select 1 union all select cast('3' as int)": [(2,), (3,)],
    "select * from (select fund_name, abn from member_flow) pivot (sum(abn) for fund_name in ('a', 'b'))": [(1, 2)],
    "select abn from member_flow -- from secret\n /* , secret */ ;": [(1,), (2,)],
    "select 'select * from secret' q, round(abn / 3, 1) r from member_flow where abn = 1": [("select * from secret", 0.3)],
}


@pytest.mark.parametrize("text", sorted(RUN))
def test_run(spark, text):
    found = selects.answer(spark, text)
    assert sorted(tuple(r.values()) for r in found.results) == RUN[text]


def test_a_table_of_another_schema_is_no_mart(spark):
    """The bare name of a mart is its view, or the table of the current schema where that is the marts'."""
    raw, mart = (f"loom_{kind}_{uuid.uuid4().hex}" for kind in ("raw", "mart"))
    for schema in (raw, mart):
        tables.create_schema(spark, schema)
        tables.replace_table(spark.range(2), f"{schema}.flows")
    readable, before = ["flows", f"{mart}.flows"], spark.catalog.currentDatabase()
    try:
        spark.catalog.setCurrentDatabase(raw)
        for text in ("select * from flows", f"select * from {raw}.flows"):
            with pytest.raises(Refused):
                selects.answer(spark, text, readable=readable)
        assert selects.answer(spark, f"select id from {mart}.flows", readable=readable).row_count == 2
        spark.catalog.setCurrentDatabase(mart)
        assert selects.answer(spark, "select id from FLOWS", readable=readable).row_count == 2
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_relations_found(spark):
    found = guard.relations(spark, "with a as (select * from x.Y), c as (select * from a, b) select * from c where k in (select 1 from `p.q`)")
    assert found == {("x", "y"), ("b",), ("p.q",)}
