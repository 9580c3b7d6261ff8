"""Data checks over the panel, the marts and the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelloom import fixed_values as fixed
from panelloom.catalogue import query
from panelloom.catalogue.marts import MARTS_SQL
from panelloom.operators import checks
from panelloom.plans import marts
from panelloom.plans.weekly import mart_checks, staging_checks
from panelloom.standins.panel import PANEL_COLUMNS, PANEL_SQL, panel
from panelloom.standins.tables import table

# Categories the stand-in checks accept.
ACCEPTED_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
REGION_TYPES = ["africa", "america", "asia", "europe"]


def result_sql(table_name: str, column: str, check: str, failures: str, source: str) -> str:
    return (
        f"select '{table_name}' as table_name, '{column}' as column_name, '{check}' as check_name, "
        f"cast({failures} as bigint) as failures from {source}"
    )


def not_null_sql(table_name: str, columns: list[str], source: str) -> list[str]:
    return [result_sql(table_name, c, "not_null", f"count(*) filter ({c} is null)", source) for c in columns]


@query("dq_not_null", f"with {PANEL_SQL} " + " union all ".join(not_null_sql("panel", PANEL_COLUMNS, "panel")))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_checks(panel(spark, sf_dir), "panel", not_null=PANEL_COLUMNS)


@query(
    "dq_accepted",
    """select o_orderpriority, count(*) as n from orders
    where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by o_orderpriority""",
)
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unaccepted(table(spark, sf_dir, "orders"), "o_orderpriority", ACCEPTED_PRIORITIES)


@query(
    "dq_unique",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1",
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_relationships", "select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return checks.orphans(documents, "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(
    "dq_row_count",
    " union all ".join(
        [
            result_sql("lineitem", "*", "row_count", "case when count(*) < 1 then 1 else 0 end", "lineitem"),
            result_sql("nation", "*", "row_count", "case when count(*) not between 1 and 20 then 1 else 0 end", "nation"),
        ]
    ),
)
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.report(
        checks.row_checks(table(spark, sf_dir, "lineitem"), "lineitem", row_count=(1, None)),
        checks.row_checks(table(spark, sf_dir, "nation"), "nation", row_count=(1, 20)),
    )


@query(
    "dq_grain",
    """select l_orderkey from (select l_orderkey, l_suppkey from lineitem)
    group by l_orderkey having min(l_suppkey) <> max(l_suppkey)""",
)
def dq_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose lines do not all come from one supplier."""
    return checks.grain_conflicts(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_suppkey"])


REPORT_SQL = f"with {MARTS_SQL} " + " union all ".join(
    [
        *not_null_sql("staging", ["abn", "fund_name", "quarter_date"], "panel"),
        result_sql(
            "staging",
            "fund_type",
            "accepted_values",
            "count(*) filter (fund_type not in ('africa', 'america', 'asia', 'europe'))",
            "panel",
        ),
        result_sql("staging", "*", "row_count", "case when count(*) < 1 then 1 else 0 end", "panel"),
        result_sql(
            "staging",
            "abn, quarter_date, product_name",
            "unique",
            "count(*)",
            "(select abn from panel group by abn, quarter_date, product_name having count(*) > 1)",
        ),
        result_sql(
            "staging",
            "abn, quarter_date",
            "one_total",
            "count(*)",
            """(select abn, quarter_date from panel group by all
                having min(member_accounts) <> max(member_accounts) or min(net_assets_m) <> max(net_assets_m))""",
        ),
        *not_null_sql("fund_performance", ["abn", "quarter_date", "rank_5yr_overall"], "fund_performance"),
        result_sql(
            "fee_vs_return",
            "value_quadrant",
            "accepted_values",
            f"count(*) filter (value_quadrant not in ({', '.join(repr(v) for v in fixed.VALUE_QUADRANTS)}))",
            "fee_vs_return",
        ),
        *not_null_sql("member_flow", ["abn", "quarter_date"], "member_flow"),
    ]
)


@query("dq_report", REPORT_SQL)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a run in one table; the region list lacks one on purpose."""
    staged = panel(spark, sf_dir)
    return checks.report(staging_checks(staged, REGION_TYPES), mart_checks(*marts.all_marts(staged).values()))
