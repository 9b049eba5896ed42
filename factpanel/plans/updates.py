"""Landing whole releases, rolling months up, and the monthly update."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factpanel.operators.unions import months_to_quarters
from factpanel.plans.state import Month, following, last_month, record_month
from factpanel.schema import PERIOD_COLS, RELEASE_TABLES, REQUIRED_TABLES
from factpanel.sources.files import list_files
from factpanel.sources.landing import Landed, land_tables, month_root, write_partitioned

Quarter = tuple[int, int]


def quarter_of(month: Month) -> Quarter:
    return month[0], (month[1] + 2) // 3


def _months_of(rows: DataFrame, quarters: list[Quarter]) -> DataFrame:
    """Rows of all landed months of the quarters, as one predicate that prunes partitions."""
    hit = F.lit(False)
    for year, number in quarters:
        hit = hit | ((F.col("year") == year) & F.col("month").between(3 * number - 2, 3 * number))
    return rows.where(hit)


def read_months(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(f"{month_root(root)}/{table}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def roll_up_months(
    spark: SparkSession, root: str, months: list[Month], tables: list[str] | None = None
) -> list[Quarter]:
    """Rebuild the quarters that the given months touch.

    A quarter is made from all its landed months, not only the given ones, so
    running it again, or for one late month, gives the same result. txt is never
    rolled up.
    """
    quarters = sorted({quarter_of(m) for m in months})
    for table in tables or RELEASE_TABLES:
        rows = None if table == "txt" else read_months(spark, root, table)
        if rows is None:
            continue
        write_partitioned(months_to_quarters(_months_of(rows, quarters)), f"{root}/{table}", PERIOD_COLS)
    return quarters


def _complete(spark: SparkSession, folders: dict[str, str]) -> bool:
    """Every folder holds a Parquet file that is not empty."""
    for path in folders.values():
        try:
            if list_files(spark, path).where("bytes > 0").isEmpty():
                return False
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
    return True


def month_complete(spark: SparkSession, root: str, month: Month) -> bool:
    top = month_root(root)
    year, number = month
    return _complete(spark, {t: f"{top}/{t}/year={year}/month={number}" for t in REQUIRED_TABLES})


def quarter_complete(spark: SparkSession, root: str, quarter: Quarter) -> bool:
    year, number = quarter
    part = f"dataset_year={year}/dataset_quarter={number}"
    return _complete(spark, {t: f"{root}/{t}/{part}" for t in REQUIRED_TABLES})


def advanced(observed: DataFrame, state: DataFrame) -> DataFrame:
    """(year, month, complete, state_year, state_month): the month that an update tries, and the
    state after it.

    observed: (year, month, table) of what was delivered; state: one row (year, month), or
    none before the first update, which then starts with the earliest month delivered. The
    state moves to the tried month if that has all required tables, else it stays.
    """
    months = observed.select((F.col("year") * 12 + F.col("month") - 1).alias("at"), "table")
    last = state.agg(F.max(F.col("year") * 12 + F.col("month") - 1)).scalar()
    first = observed.agg(F.min(F.col("year") * 12 + F.col("month") - 1)).scalar()
    there = F.count_distinct(F.when(F.col("table").isin(REQUIRED_TABLES), F.col("table")))
    tried = months.where(F.col("at") == F.coalesce(last + 1, first))
    # an aggregate without keys: a line also if nothing was delivered for the month
    line = tried.agg((there == len(REQUIRED_TABLES)).alias("complete"))
    line = line.withColumns({"at": F.coalesce(last + 1, first), "last": last})
    after = F.when(F.col("complete"), F.col("at")).otherwise(F.col("last"))

    def month(at: Column) -> tuple[Column, Column]:
        return F.floor(at / 12).cast("int"), (F.pmod(at, F.lit(12)) + 1).cast("int")

    year, number = month(F.col("at"))
    state_year, state_month = month(after)
    return line.select(
        year.alias("year"), number.alias("month"), "complete", state_year.alias("state_year"), state_month.alias("state_month")
    )


def delivered(spark: SparkSession, root: str, month: Month) -> DataFrame:
    """(year, month, table) of the required tables that were landed for a month with a file
    that is not empty."""
    top, (year, number) = month_root(root), month
    found = [t for t in REQUIRED_TABLES if _complete(spark, {t: f"{top}/{t}/year={year}/month={number}"})]
    return spark.createDataFrame([(year, number, t) for t in found], "year int, month int, table string")


def candidate_month(last: Month | None, today: dt.date | None = None) -> Month:
    """Month after the last one done; before any, the month before today."""
    if last is not None:
        return following(last)
    day = (today or dt.date.today()).replace(day=1) - dt.timedelta(days=1)
    return day.year, day.month


def run_monthly_update(
    spark: SparkSession,
    raw_root: str,
    root: str,
    today: dt.date | None = None,
    multi_line: bool | None = None,
) -> bool:
    """Land the next month, roll its quarter up, and advance only if both are complete.

    Returns whether the state advanced; a month that is not there yet, or lacks a
    required table, leaves it where it is.
    """
    month = candidate_month(last_month(spark, root), today)
    land_tables(spark, raw_root, root, months=True, only=[month], multi_line=multi_line)
    year, number = month
    before = (year, number - 1) if number > 1 else (year - 1, 12)
    state = spark.createDataFrame([before], "year int, month int")
    if not advanced(delivered(spark, root, month), state).first()["complete"]:
        return False
    roll_up_months(spark, root, [month])
    if not quarter_complete(spark, root, quarter_of(month)):
        return False
    record_month(spark, root, month)
    return True


def run_pipeline(
    spark: SparkSession,
    raw_root: str,
    root: str,
    quarters: list[Quarter] | None = None,
    months: list[Month] | None = None,
    include_txt: bool = False,
    multi_line: bool | None = None,
) -> list[Landed]:
    """Land all quarters and months there are (or the given ones), then roll up."""
    options = {"include_txt": include_txt, "multi_line": multi_line}
    done = land_tables(spark, raw_root, root, only=quarters, **options)
    done += land_tables(spark, raw_root, root, months=True, only=months, **options)
    if months is None:
        landed = read_months(spark, root, "sub")
        months = [] if landed is None else [
            tuple(r) for r in landed.select("year", "month").distinct().collect()
        ]
    if months:
        roll_up_months(spark, root, months)
    return done
