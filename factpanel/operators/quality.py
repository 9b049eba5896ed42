"""Data-quality checks. Each is one aggregate over all periods at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.functions.ids import Period, period_key
from factpanel.schema import PANEL_REQUIRED_COLS, PERIOD_COLS, REQUIRED_TABLES

# Messages of the panel check.
MISSING_COLUMNS = "Missing required columns: "
NULL_COMPANY = "Some rows contain null CIK."
NEGATIVE_REVENUE = "Negative revenue detected — unusual, check source."


def _texts(*items: Column) -> Column:
    """Array of the texts that are not null."""
    return F.array_compact(F.array(*items))


def _status(issues: Column) -> Column:
    return F.when(F.size(issues) > 0, F.lit("ISSUES")).otherwise(F.lit("OK"))


def periods_of(df: DataFrame) -> DataFrame:
    """Periods present, from the partition columns."""
    return df.select(*PERIOD_COLS).distinct()


def earliest_periods(df: DataFrame, n: int) -> DataFrame:
    return periods_of(df).orderBy(*PERIOD_COLS).limit(n)


def in_periods(df: DataFrame, periods: list[Period]) -> DataFrame:
    """Rows of the listed periods, as a predicate that prunes partitions."""
    hit = F.lit(False)
    for year, quarter in periods:
        hit = hit | ((F.col("dataset_year") == year) & (F.col("dataset_quarter") == quarter))
    return df.where(hit)


def first_periods(df: DataFrame, n: int) -> list[Period]:
    """The earliest ``n`` periods as tuples, for :func:`in_periods`."""
    return [tuple(r) for r in earliest_periods(df, n).collect()]


def row_count_snapshot(tables: dict[str, DataFrame], by: list[str] | None = None) -> DataFrame:
    """Rows per table and period. Only the partition columns are read."""
    by = PERIOD_COLS if by is None else by
    counts = [
        df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), *by, "n_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def period_completeness(
    observed: DataFrame,
    required: list[str] | None = None,
    periods: DataFrame | None = None,
    min_bytes: int | None = None,
) -> DataFrame:
    """Per period: any table there, all required ones there, which are missing.

    ``observed`` has one row per period and table, or per file (then with
    ``bytes``, and ``min_bytes`` leaves empty files out). ``periods`` adds periods
    without any table: they do not exist, and list nothing as missing.
    """
    required = list(required or REQUIRED_TABLES)
    there = F.col("table").isin(required)
    if min_bytes is not None:
        there = there & (F.col("bytes") >= min_bytes)
    rows = observed.select(
        *PERIOD_COLS, F.when(there, F.col("table")).alias("table"), F.lit(True).alias("seen")
    )
    if periods is not None:
        rows = rows.unionByName(periods.select(*PERIOD_COLS), allowMissingColumns=True)
    # at most the required names are collected per period
    found = rows.groupBy(*PERIOD_COLS).agg(
        F.collect_set("table").alias("found"),
        F.coalesce(F.bool_or("seen"), F.lit(False)).alias("exists"),
    )
    wanted = F.array(*[F.lit(t) for t in required])
    nothing = F.array().cast("array<string>")
    missing = F.when(F.col("exists"), F.array_except(wanted, "found")).otherwise(nothing)
    complete = F.col("exists") & (F.size("missing_files") == 0)
    return (
        found.withColumn("missing_files", missing)
        .withColumn("complete", complete)
        .select(*PERIOD_COLS, "exists", "complete", "missing_files")
    )


def not_found(periods: DataFrame) -> DataFrame:
    """Lines of an integrity check for periods that lack its table."""
    none, null = F.array().cast("array<string>"), F.lit(None).cast("bigint")
    return periods.select(
        *PERIOD_COLS,
        F.lit("NOT_FOUND").alias("status"),
        none.alias("issues"),
        none.alias("warnings"),
        null.alias("null_value_count"),
        null.alias("null_ddate_count"),
    )


def _with_missing(rows: DataFrame, periods: DataFrame | None) -> DataFrame:
    if periods is None:
        return rows
    return rows.unionByName(not_found(periods.join(rows, PERIOD_COLS, "left_anti")).select(*rows.columns))


def sub_integrity(sub: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Filing headers: null id and null name are issues, repeated ids a warning. ``periods``
    that the table lacks get a line too."""
    no_name = F.count_if(F.col("name").isNull()) if "name" in sub.columns else F.lit(0)
    company = F.col("cik") if "cik" in sub.columns else F.lit(None)
    has_id = "cik" in sub.columns
    per_company = sub.groupBy(*PERIOD_COLS, company.alias("cik")).agg(
        F.count(F.lit(1)).alias("n"), no_name.cast("bigint").alias("no_name")
    )
    null_id = F.sum(F.when(F.col("cik").isNull(), F.col("n")).otherwise(0))
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    counts = per_company.groupBy(*PERIOD_COLS).agg(
        (null_id if has_id else F.sum(F.lit(0))).alias("null_cik"),
        F.sum("no_name").alias("null_name"),
        (repeated if has_id else F.sum(F.lit(0))).alias("repeated"),
    )
    issues = _texts(
        F.when(F.col("null_cik") > 0, F.lit("null_cik")),
        F.when(F.col("null_name") > 0, F.lit("null_name")),
    )
    warning = F.format_string("duplicate_cik (%d)", F.col("repeated"))
    found = counts.select(
        *PERIOD_COLS,
        _status(issues).alias("status"),
        issues.alias("issues"),
        _texts(F.when(F.col("repeated") > 0, warning)).alias("warnings"),
    )
    return _with_missing(found, periods)


def num_integrity(num: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Facts: a missing value column is an issue; null counts are reported. ``periods`` that
    the table lacks get a line too."""
    has_value = "value" in num.columns
    counts = {f"null_{c}_count": c for c in ("value", "ddate") if c in num.columns}
    measures = [F.count_if(F.col(c).isNull()).alias(name) for name, c in counts.items()]
    rows = num.groupBy(*PERIOD_COLS).agg(F.count(F.lit(1)).alias("n_rows"), *measures)
    issues = _texts(F.lit(None if has_value else "missing_value_column").cast("string"))
    null = F.lit(None).cast("bigint")
    found = rows.select(
        *PERIOD_COLS,
        _status(issues).alias("status"),
        issues.alias("issues"),
        (F.col("null_value_count") if has_value else null).alias("null_value_count"),
        (F.col("null_ddate_count") if "ddate" in num.columns else null).alias("null_ddate_count"),
    )
    return _with_missing(found, periods)


def validate_panel(df: DataFrame) -> DataFrame:
    """One row: status, the messages, the row count."""
    missing = [c for c in PANEL_REQUIRED_COLS if c not in df.columns]
    no = F.lit(0)
    null_id = F.count_if(F.col("cik").isNull()) if "cik" in df.columns else no
    negative = F.count_if(F.col("revenue") < 0) if "revenue" in df.columns else no
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), null_id.alias("null_id"), negative.alias("negative")
    )
    errors = _texts(
        F.lit(MISSING_COLUMNS + str(missing) if missing else None).cast("string"),
        F.when(F.col("null_id") > 0, F.lit(NULL_COMPANY)),
        F.when(F.col("negative") > 0, F.lit(NEGATIVE_REVENUE)),
    )
    return counts.select(_status(errors).alias("status"), errors.alias("errors"), "n_rows")


def check_report(
    completeness: DataFrame | None = None,
    sub_checks: DataFrame | None = None,
    num_checks: DataFrame | None = None,
    panel_check: DataFrame | None = None,
    counts: DataFrame | None = None,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """All check tables as one long report: check, period, status, issues, meta."""
    key = period_key(*PERIOD_COLS)
    none = F.array().cast("array<string>")
    nothing = F.create_map().cast("map<string,string>")

    def line(df: DataFrame, check, period, status, issues, meta=nothing) -> DataFrame:
        return df.select(
            F.lit(check).alias("check") if isinstance(check, str) else check.alias("check"),
            period.cast("string").alias("period"),
            status.alias("status"),
            issues.alias("issues"),
            meta.alias("meta"),
        )

    def meta_of(*names: str) -> Column:
        pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

    parts = []
    if completeness is not None:
        state = (
            F.when(~F.col("exists"), F.lit("NOT_FOUND"))
            .when(F.col("complete"), F.lit("OK"))
            .otherwise(F.lit("ISSUES"))
        )
        parts.append(line(completeness, "periods", key, state, F.col("missing_files")))
    if sub_checks is not None:
        meta = F.create_map(F.lit("warnings"), F.concat_ws(", ", "warnings"))
        parts.append(line(sub_checks, "sub", key, F.col("status"), F.col("issues"), meta))
    if num_checks is not None:
        meta = meta_of("null_value_count", "null_ddate_count")
        parts.append(line(num_checks, "num", key, F.col("status"), F.col("issues"), meta))
    if panel_check is not None:
        everything = F.lit(None).cast("string")
        cols = (F.col("status"), F.col("errors"), meta_of("n_rows"))
        parts.append(line(panel_check, "fundamentals", everything, *cols))
    if counts is not None:
        name = F.concat(F.lit("rows_"), F.col("table"))
        parts.append(line(counts, name, key, F.lit("OK"), none, meta_of("n_rows")))
    if unreadable is not None:
        issue = F.array(F.concat_ws(": ", "path", "error"))
        parts.append(
            line(unreadable, "files", F.lit(None).cast("string"), F.lit("ISSUES"), issue)
        )
    return reduce(DataFrame.unionByName, parts)
