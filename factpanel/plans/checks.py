"""All checks, and the coverage audit, over a landed root."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factpanel.operators.audit import audit_quarters
from factpanel.operators.quality import (
    check_report,
    first_periods,
    not_found,
    num_integrity,
    period_completeness,
    row_count_snapshot,
    sub_integrity,
    validate_panel,
)
from factpanel.plans.fundamentals import fundamentals_panel
from factpanel.schema import PERIOD_COLS, REQUIRED_TABLES
from factpanel.sources.files import list_files, unreadable_files
from factpanel.sources.sinks import write_csv
from factpanel.sources.tables import FOLDERS, FactTables


def _said(error: Exception) -> str:
    """Class and first line of an error; of one that comes from Java as it is, those of its cause."""
    java = getattr(error, "java_exception", None)
    if java is not None:
        while java.getCause() is not None:
            java = java.getCause()
        return f"{java.getClass().getSimpleName()}: {(java.getMessage() or '').split(chr(10))[0]}"
    return f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"


def _panel_line(tables: FactTables, status: str, errors: list[str]) -> DataFrame:
    row = [(status, errors, 0)]
    return tables.spark.createDataFrame(row, "status string, errors array<string>, n_rows bigint")


def panel_check(tables: FactTables, max_periods: int | None = None) -> DataFrame:
    """Structure of the panel, or of its earliest ``max_periods`` periods where that is given."""
    periods = None if max_periods is None else first_periods(tables.inventory(), max_periods)
    if tables.inventory().isEmpty():
        return _panel_line(tables, "NO_DATA", [])
    try:
        checked = validate_panel(fundamentals_panel(tables, periods))
        # the panel fails at run time on bad text: find out here, on one row
        row = checked.first()
        return tables.spark.createDataFrame([row], checked.schema)
    except Exception as error:  # any failure is the finding
        return _panel_line(tables, "ERROR", [_said(error)])


def _settled(tables: FactTables, name: str, make: Callable[[], DataFrame | None]) -> DataFrame:
    """Lines of one check, or one line that says why it failed.

    A report line stands for a period or a table, so the lines are few; taking
    them now keeps an error in one check away from the others.
    """
    schema = "check string, period string, status string, issues array<string>, meta map<string,string>"
    try:
        lines = make()
        rows = [] if lines is None else lines.collect()
    except Exception as error:  # any failure is the finding
        rows = [(name, None, "ERROR", [_said(error)], {})]
    return tables.spark.createDataFrame(rows, schema)


def run_checks(tables: FactTables) -> DataFrame:
    """Every check in one report; a check that fails leaves the others standing."""

    def of_table(table: str, argument: str, check: Callable[[DataFrame], DataFrame]):
        def make() -> DataFrame | None:
            df = tables.find(table)
            return None if df is None else check_report(**{argument: check(df)})

        return make

    def integrity(table: str, argument: str, check):
        def make() -> DataFrame | None:
            periods = tables.inventory().select(*PERIOD_COLS).distinct()
            df = tables.find(table)
            return check_report(**{argument: not_found(periods) if df is None else check(df, periods)})

        return make

    parts = {
        "periods": lambda: check_report(completeness=period_completeness(tables.inventory())),
        "sub": integrity("sub", "sub_checks", sub_integrity),
        "num": integrity("num", "num_checks", num_integrity),
        "fundamentals": lambda: check_report(panel_check=panel_check(tables)),
    }
    for t in REQUIRED_TABLES:
        parts[f"rows_{t}"] = of_table(t, "counts", lambda df, t=t: row_count_snapshot({t: df}))
    settled = [_settled(tables, name, make) for name, make in parts.items()]
    files = list_files(tables.spark, tables.root)
    return reduce(DataFrame.union, settled, check_report(unreadable=unreadable_files(files)))


def run_audit(
    tables: FactTables, known: dict[str, str] | None = None, output_csv: str | None = None
) -> DataFrame:
    """Audit of every period of the root. Paths start at the last part of the root, so that
    they tell nothing of the machine."""
    rows = audit_quarters(tables.find("sub"), tables.find("num"), known, tables.inventory())
    name = tables.root.rsplit("/", 1)[-1]
    year, quarter = (F.col(c).cast("string") for c in PERIOD_COLS)
    if tables.layout == FOLDERS:
        period = F.concat(F.lit(f"{name}/"), year, F.lit("_"), quarter)
        parquet = F.concat(period, F.lit("/parquet"))
    else:  # the tables are folders above the periods
        period = F.concat(F.lit("dataset_year="), year, F.lit("/dataset_quarter="), quarter)
        parquet = F.concat(F.lit(f"{name}/*/"), period)
    rows = rows.withColumns({"data_root": F.lit(name), "period_dir": period, "parquet_dir": parquet})
    first = ["quarter", "data_root", "period_dir", "parquet_dir"]
    rows = rows.select(*first, *[c for c in rows.columns if c not in first])
    if output_csv:
        write_csv(rows.orderBy("quarter"), output_csv)
    return rows
