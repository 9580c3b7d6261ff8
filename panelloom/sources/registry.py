"""The data sets a run loads: where each lands and how it becomes a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from panelloom.plans.merge import merge_sheets
from panelloom.sources.sheets import first_sheet_table


@dataclass(frozen=True)
class Dataset:
    """A registered source: its key, its raw table and its reader of cells and, as ``sheets``, their descriptions."""

    key: str
    table: str
    reader: Callable[..., DataFrame]


DATASETS = {
    d.key: d
    for d in (
        Dataset("product_quarterly", "product_quarterly", merge_sheets),
        Dataset("fund_quarterly", "fund_quarterly", first_sheet_table),
        Dataset("annual_bulletin", "annual_bulletin", first_sheet_table),
    )
}
