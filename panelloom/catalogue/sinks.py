"""Writes and what they leave behind, read back."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.catalogue import query
from panelloom.catalogue.marts import FLOW_SQL, GROWTH_SQL, PERFORMANCE_SQL
from panelloom.plans import marts
from panelloom.plans.refresh import refresh_marts
from panelloom.plans.weekly import load_all, weekly_run
from panelloom.session import fresh_path
from panelloom.sinks import tables, versions
from panelloom.sources.snapshots import read_snapshot
from panelloom.standins.panel import PANEL_SQL, panel
from panelloom.standins.tables import table
from panelloom.standins.workbooks import POINTS_SQL, customer_workbook, landed, landed_products

FIRST, SECOND = date(2026, 1, 5), date(2026, 1, 12)
LOADED_AT = datetime(2026, 1, 5, 22)
REGIONS = ["africa", "america", "asia", "europe", "middle east"]


def own_schema(spark: SparkSession) -> str:
    """A schema of this call's own, its tables in the scratch folder."""
    name = f"loom_{uuid.uuid4().hex}"
    tables.create_schema(spark, name, fresh_path(spark, name))
    return name


@query(
    "snapshot_read",
    """with filed as (select 'customers_' || (c_custkey // 1000000) as file, * from customer)
    select file, cast(c_custkey % 1000000 + 1 as integer) as row_idx, c_mktsegment as segment from filed
    union all select distinct file, 0, 'Market segment' from filed""",
)
def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data set of one date out of an archive that holds two of each."""
    root = fresh_path(spark, "archive")
    books = customer_workbook(spark, sf_dir).withColumn("dataset", F.lit("fund_quarterly"))
    tables.archive(books.unionByName(books.withColumn("dataset", F.lit("annual_bulletin"))), root, FIRST)
    tables.archive(books.withColumn("cells", F.array()), root, SECOND)
    rows = read_snapshot(spark, root, FIRST, "fund_quarterly")
    return rows.select("file", "row_idx", F.get("cells", F.lit(3)).alias("segment"))


@query(
    "archive_roundtrip",
    f"""with {POINTS_SQL}, books as (select count(*) as n from funds), data as (select count(*) as n from points join funds using (abn))
    select cast(run_date as date) as run_date, sheet, head * books.n + body * data.n as n_rows
    from books, data, (values ('2026-01-05'), ('2026-01-12')) as d(run_date),
         (values (' Cover', 2, 0), ('Table 1a', 4, 1), ('Table 2a', 6, 1), ('Table 4', 3, 1)) as s(sheet, head, body)""",
)
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates archived, the second loaded twice; rows per date and sheet."""
    root = fresh_path(spark, "archive")
    books = landed_products(spark, sf_dir).withColumn("dataset", F.lit("product_quarterly"))
    for run_date in (FIRST, SECOND, SECOND):
        tables.archive(books, root, run_date)
    both = read_snapshot(spark, root, FIRST).unionByName(read_snapshot(spark, root, SECOND))
    return both.groupBy("run_date", "sheet").agg(F.count("*").alias("n_rows"))


@query("replace_load", "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders")
def replace_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded, then replaced by other columns and rows."""
    name = f"{own_schema(spark)}.orders"
    tables.replace_table(table(spark, sf_dir, "customer"), name)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    tables.replace_table(orders, name)
    return spark.table(name)


@query(
    "load_all",
    """select 'annual_bulletin' as table_name, count(*) as n_rows, date '2026-01-05' as run_date from part
    union all select 'fund_quarterly', count(*), date '2026-01-05' from customer
    union all select 'product_quarterly', count(*), date '2026-01-05'
      from (select distinct l_suppkey, date_trunc('quarter', l_shipdate), l_returnflag from lineitem)""",
)
def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All registered data sets from one snapshot to raw tables."""
    root, schema = fresh_path(spark, "archive"), own_schema(spark)
    tables.archive(landed(spark, sf_dir), root, FIRST)
    loaded = load_all(spark, root, FIRST, LOADED_AT, schema)
    rows = [
        spark.table(name).groupBy(F.lit(name.split(".")[1]).alias("table_name"), F.col("_run_date").alias("run_date"))
        for name in sorted(loaded)
    ]
    counts = [r.agg(F.count("*").alias("n_rows")) for r in rows]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("mart_table", f"with {FLOW_SQL} select * from member_flow")
def mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as the run stores it: laid out by quarter, read in its own column order."""
    name = f"{own_schema(spark)}.member_flow"
    tables.replace_partitioned(marts.member_flow(panel(spark, sf_dir)), name, "quarter_date")
    return spark.table(name)


@query(
    "parquet_sink_count",
    f"""with {PANEL_SQL} select 'quarterly_aggregation' as table_name, count(*) as written, count(*) as found
    from panel where return_5yr is not null""",
)
def parquet_sink_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined job written and counted in one go, next to a later count."""
    path = fresh_path(spark, "aggregated")
    written = tables.write_counted(marts.quarterly_aggregation(panel(spark, sf_dir)), path)
    return spark.read.parquet(path).agg(
        F.lit("quarterly_aggregation").alias("table_name"),
        F.lit(written).cast("bigint").alias("written"),
        F.count("*").alias("found"),
    )


@query(
    "latest_per_key",
    """select user_id, event_id, event_type, value from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return tables.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "upsert_latest",
    """select user_id, event_type, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events before mid-January as a table, the others brought in twice."""
    path = fresh_path(spark, "upserted")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts", "event_type")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    tables.start_table(tables.latest_per_key(events.where(early), keys, order), path, "event_type")
    for _ in range(2):
        tables.upsert(spark, events.where(~early), path, keys, order, "event_type")
    return spark.read.schema(events.schema).parquet(path).drop("ts")


@query(
    "versioned_upsert",
    """select user_id, event_type, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
)
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same updates, brought in twice to a table that switches between generations."""
    name = f"{own_schema(spark)}.events"
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts", "event_type")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    versions.replace(tables.latest_per_key(events.where(early), keys, order), name, "event_type")
    for _ in range(2):
        versions.upsert(events.where(~early), name, keys, order)
    return spark.table(name).drop("ts")


@query(
    "refreshed_flow",
    f"with {FLOW_SQL} select * from member_flow",
)
def refreshed_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow mart of a run that lacked half the funds of one year, brought up to date by a run with all rows."""
    schema, staged = own_schema(spark), panel(spark, sf_dir)
    late = (F.year("quarter_date") == 1995) & (F.col("abn") % 2 == 1)
    for rows in (staged.where(~late), staged, staged):
        keep = refresh_marts(rows, schema)[2]
        keep()
    return spark.table(f"{schema}.member_flow")


@query(
    "newest_of_stored_mart",
    f"with {PERFORMANCE_SQL} select * from fund_performance where quarter_date = (select max(quarter_date) from fund_performance)",
)
def newest_of_stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest quarter of a stored mart, told without reading a row."""
    name = f"{own_schema(spark)}.fund_performance"
    versions.replace(marts.fund_performance(panel(spark, sf_dir)), name, "quarter_date")
    return versions.newest(spark, name)


@query(
    "full_run",
    f"""with {POINTS_SQL},
    grain as (
      select p.abn, quarter_date, fund_name, fund_type, coalesce(sum(cents), 0) as cents, sum(qty) as members
      from points p join funds f on f.abn = p.abn group by all
    ),
    lagged as (
      select *, lag(cents) over w as cents_before, lag(members) over w as members_before
      from grain window w as (partition by abn order by quarter_date)
    )
    select fund_name, cast(abn as varchar) as abn, fund_type, quarter_date, cast(members as bigint) as member_accounts,
      cast(cents as double) / 100 as net_assets_m, cast(members - members_before as bigint) as member_net_change,
      cast({GROWTH_SQL.format(now='members', before='members_before')} as double) as member_growth_pct,
      cast(cents - cents_before as double) / 100 as asset_net_change_m,
      cast(sum(members - members_before) over (
        partition by abn order by quarter_date rows between 3 preceding and current row) as bigint)
        as rolling_annual_member_change
    from lagged where members_before is not null""",
)
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to checked marts under one run date; the flow mart read back from its table."""
    root, raw, mart = fresh_path(spark, "archive"), own_schema(spark), own_schema(spark)
    weekly_run(spark, landed(spark, sf_dir), root, FIRST, LOADED_AT, raw, mart, REGIONS)
    amounts = ["net_assets_m", "asset_net_change_m", "member_growth_pct"]
    return spark.table(f"{mart}.member_flow").withColumns({c: F.col(c).cast("double") for c in amounts})


@query(
    "load_rows",
    """select cast(c_custkey as varchar) as "Customer key", cast(null as varchar) as "Unnamed: 1",
      cast(c_acctbal as varchar) as "Account balance (AUD)", c_mktsegment as "Market segment",
      lower(c_mktsegment) as "Market segment.1", date '2026-01-05' as _run_date from customer""",
)
def load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a raw table that was loaded from a snapshot."""
    root, schema = fresh_path(spark, "archive"), own_schema(spark)
    books = customer_workbook(spark, sf_dir).withColumn("dataset", F.lit("fund_quarterly"))
    tables.archive(books, root, FIRST)
    load_all(spark, root, FIRST, LOADED_AT, schema, ["fund_quarterly"])
    return spark.table(f"{schema}.fund_quarterly").drop("_loaded_at")
