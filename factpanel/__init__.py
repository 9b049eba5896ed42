"""Company filings as long facts: landing, wide rows, panels, screens and audits on Spark."""

from factpanel.functions.ids import period_str
from factpanel.operators.facts import build_fundamentals
from factpanel.plans.checks import run_audit, run_checks
from factpanel.plans.fundamentals import (
    enrich_panel,
    fundamentals,
    fundamentals_panel,
    numeric_fundamentals,
    sheet_fundamentals,
)
from factpanel.plans.screening import run_screening_job, run_simple_screener, simple_screener
from factpanel.plans.updates import roll_up_months, run_monthly_update, run_pipeline
from factpanel.sources.landing import land_tables
from factpanel.sources.tables import FactTables
from factpanel.streaming.months import land_new_months

__all__ = [
    "FactTables",
    "build_fundamentals",
    "enrich_panel",
    "fundamentals",
    "fundamentals_panel",
    "land_new_months",
    "land_tables",
    "numeric_fundamentals",
    "period_str",
    "roll_up_months",
    "run_audit",
    "run_checks",
    "run_monthly_update",
    "run_pipeline",
    "run_screening_job",
    "run_simple_screener",
    "sheet_fundamentals",
    "simple_screener",
]
