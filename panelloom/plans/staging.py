"""The staging view: the raw panel with its contract types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.values import category, date_key, misfit, rounded_count, trimmed_text

RATES = ["return_1yr", "return_3yr", "return_5yr", "investment_fee_pct", "admin_fee_pct", "total_fee_pct"]
RATE_TYPE = "decimal(10,6)"
ASSETS_TYPE = "decimal(18,2)"


def staging(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Trim, cast and keep rows that have a fund name and a quarter.

    In strict mode a value that does not fit its type raises; otherwise it
    becomes null; ``parsed`` gives the same rows and, out of the same scan,
    what was refused and why.
    """
    cast = lambda c, kind: F.col(c).cast(kind) if strict else F.col(c).try_cast(kind)
    audit = [c for c in ("_loaded_at", "_run_date") if c in raw.columns]
    rows = raw.where(F.col("fund_name").isNotNull() & F.col("quarter_year").isNotNull())
    return rows.select(
        trimmed_text(F.col("fund_name")).alias("fund_name"),
        trimmed_text(F.col("abn")).alias("abn"),
        trimmed_text(F.col("product_name")).alias("product_name"),
        date_key(F.col("quarter_year"), strict).alias("quarter_date"),
        *[cast(c, RATE_TYPE).alias(c) for c in RATES],
        cast("net_assets_m", ASSETS_TYPE).alias("net_assets_m"),
        rounded_count(F.col("member_accounts"), strict).alias("member_accounts"),
        category(F.col("fund_type")).alias("fund_type"),
        *audit,
    )


REFUSED = "array<struct<column:string,text:string,reason:string>>"
ROW = ["abn", "product_name", "quarter_year"]


def parsed(raw: DataFrame) -> DataFrame:
    """Every raw row with its typed values, read once, and what was refused of it.

    ``refused`` lists (column, text, reason) of each value that has no place in
    its type, in the order of the staged columns: ``not a number``, ``out of
    range``, ``not a date``; and ``missing`` for a row that staging leaves out
    because it has no fund name or no quarter. ``raw_row`` holds the raw abn,
    product name and quarter as texts, ``staged`` tells whether the row stays.
    """
    typed = {
        "quarter_date": date_key(F.col("quarter_year"), strict=False),
        **{c: F.col(c).try_cast(RATE_TYPE) for c in RATES},
        "net_assets_m": F.col("net_assets_m").try_cast(ASSETS_TYPE),
        "member_accounts": rounded_count(F.col("member_accounts"), strict=False),
    }

    def refusal(column: str, reason: Column) -> Column:
        text = F.col(column).cast("string").alias("text")
        return F.when(reason.isNotNull(), F.struct(F.lit(column).alias("column"), text, reason.alias("reason")))

    numbers = [c for c in typed if c != "quarter_date"]
    quarter = F.col("quarter_year")
    refused = [
        refusal("fund_name", F.when(F.col("fund_name").isNull(), "missing")),
        refusal(
            "quarter_year",
            F.when(quarter.isNull(), "missing").when(typed["quarter_date"].isNull(), "not a date"),
        ),
        *[refusal(c, misfit(F.col(c), typed[c])) for c in numbers],
    ]
    return raw.select(
        trimmed_text(F.col("fund_name")).alias("fund_name"),
        trimmed_text(F.col("abn")).alias("abn"),
        trimmed_text(F.col("product_name")).alias("product_name"),
        *[value.alias(c) for c, value in typed.items()],
        category(F.col("fund_type")).alias("fund_type"),
        *[c for c in ("_loaded_at", "_run_date") if c in raw.columns],
        F.struct(*[F.col(c).cast("string").alias(c) for c in ROW]).alias("raw_row"),
        (F.col("fund_name").isNotNull() & quarter.isNotNull()).alias("staged"),
        F.filter(F.array(*refused), lambda r: r.isNotNull()).cast(REFUSED).alias("refused"),
    )


def staged_rows(rows: DataFrame) -> DataFrame:
    """The staging view out of ``parsed`` rows: what did not fit is null."""
    return rows.where("staged").drop("raw_row", "staged", "refused")


def quarantine(rows: DataFrame) -> DataFrame:
    """(abn, product_name, quarter_year, column, text, reason): one row for each refused value of ``parsed`` rows."""
    return rows.select("raw_row.*", F.explode("refused").alias("refusal")).select(*ROW, "refusal.*")


def unstaged(raw: DataFrame) -> DataFrame:
    """Raw rows holding a value that lenient staging would lose."""
    lost = F.lit(False)
    for column in [*RATES, "net_assets_m"]:
        kind = ASSETS_TYPE if column == "net_assets_m" else RATE_TYPE
        lost = lost | (F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())
    for column, typed in {"member_accounts": rounded_count, "quarter_year": date_key}.items():
        lost = lost | (F.col(column).isNotNull() & typed(F.col(column), strict=False).isNull())
    return raw.where(lost)
