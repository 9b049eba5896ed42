"""Fundamentals of one period, of many, and the enriched panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factpanel.functions.ids import Period
from factpanel.functions.numeric import lenient_columns
from factpanel.operators.facts import build_fundamentals, facts_of_filings, filter_forms, scan_typed
from factpanel.operators.panel import BLOCK_ROWS, company_ttm, over_companies, panel_columns, place_in_companies
from factpanel.operators.screens import sheet_subset
from factpanel.schema import NUMERIC_COLS
from factpanel.sources.tables import FactTables


def _typed(tables: FactTables, period, strict: bool) -> tuple[DataFrame, DataFrame]:
    sub, num = tables.sub_num(period)
    return scan_typed(sub, strict), num


def fundamentals(
    tables: FactTables,
    period: Period | str | None = None,
    forms: list[str] | None = None,
    tags: dict[str, list[str]] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Wide filing rows with ratios, of one period or of all the tables hold."""
    sub, num = _typed(tables, period, strict)
    return build_fundamentals(sub, num, forms, tags, strict)


def numeric_fundamentals(tables: FactTables, period: Period | str, **options) -> DataFrame:
    """Single-period fundamentals with every numeric column cast leniently."""
    return lenient_columns(fundamentals(tables, period, **options), NUMERIC_COLS)


def fundamentals_panel(
    tables: FactTables,
    periods: list[Period | str] | None = None,
    forms: list[str] | None = None,
    tags: dict[str, list[str]] | None = None,
    strict: bool = True,
    enrich: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Panel of many periods in one plan; ``enrich`` adds the time-series columns."""
    if periods is not None:
        if not periods:
            raise ValueError("periods must not be empty")
        tables = tables.only(periods)
    sub, num = _typed(tables, None, strict)
    if not enrich:
        return build_fundamentals(sub, num, forms, tags, strict)
    # the filings are placed before the facts are joined: only narrow rows move for it
    placed = place_in_companies(filter_forms(sub, forms), block_rows=block_rows)
    return enrich_panel(build_fundamentals(placed, num, forms, tags, strict))


def sheet_fundamentals(
    tables: FactTables, years: list[int], quarters: list[int], n: int | None = 10, **options
) -> DataFrame:
    """Display columns of a panel, highest revenue first. Years and quarters are
    paired up; the shorter list decides."""
    return sheet_subset(fundamentals_panel(tables, list(zip(years, quarters)), **options), n)


def enrich_panel(panel: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Yearly changes, trailing sums and steps for a panel."""
    return over_companies(panel, panel_columns(), block_rows=block_rows)


def fundamentals_of_companies(
    sub: DataFrame, num: DataFrame, ciks: list[int], forms: list[str] | None = None,
    tags: dict[str, list[str]] | None = None, strict: bool = True,
) -> DataFrame:
    """Wide rows of some companies. Only facts of their filings get as far as the pivot."""
    filings = filter_forms(sub, forms).where(F.col("cik").isin(ciks))
    return build_fundamentals(filings, facts_of_filings(num, filings), forms, tags, strict)


def trailing_metric(
    sub: DataFrame, num: DataFrame, cik: int, metric: str,
    forms: list[str] | None = None, tags: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Trailing sum of one metric of one company, from its own facts."""
    return company_ttm(fundamentals_of_companies(sub, num, [cik], forms, tags), cik, metric, check=False)
