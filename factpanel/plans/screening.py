"""Screening jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factpanel.functions.ids import Period
from factpanel.operators.merge import merge_metrics
from factpanel.operators.screens import revenue_screen, threshold_screen
from factpanel.plans.fundamentals import numeric_fundamentals
from factpanel.plans.state import SCREENED, last_month, record_month
from factpanel.sources.sinks import write_csv, write_json
from factpanel.sources.tables import FactTables


def simple_screener(
    sub: DataFrame,
    num: DataFrame,
    min_revenue: float | None = None,
    min_net_margin: float | None = None,
    max_rows: int | None = None,
    collapse: str | None = None,
    tags: dict[str, str] | None = None,
    forms: list[str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Screener table under the given bounds."""
    rows = merge_metrics(sub, num, forms, tags, collapse, strict)
    return threshold_screen(rows, min_revenue, min_net_margin, max_rows)


def run_simple_screener(
    tables: FactTables,
    period: Period | str,
    min_revenue: float | None = None,
    min_net_margin: float | None = None,
    max_rows: int | None = None,
    output_csv: str | None = None,
    output_json: str | None = None,
    collapse: str | None = None,
) -> DataFrame:
    """Simple screener over one period, written as CSV and JSON where asked for."""
    sub, num = tables.sub_num(period)
    rows = simple_screener(sub, num, min_revenue, min_net_margin, max_rows, collapse)
    if output_csv:
        write_csv(rows, output_csv)
    if output_json:
        write_json(rows, output_json)
    return rows


def run_screening_job(tables: FactTables, out_root: str) -> str | None:
    """Screen the quarter of the last landed month, once per month.

    Does nothing when no month was landed or the last one was screened already.
    Returns the path of the written report.
    """
    landed = last_month(tables.spark, tables.root)
    screened = last_month(tables.spark, tables.root, SCREENED)
    if landed is None or (screened is not None and screened >= landed):
        return None
    year, month = landed
    rows = numeric_fundamentals(tables, (year, (month + 2) // 3))
    path = f"{out_root}/fundamentals_screener_{year}_{month:02d}"
    write_csv(revenue_screen(rows), path)
    record_month(tables.spark, tables.root, landed, SCREENED)
    return path
