"""Threshold screens, rankings and projections over panels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factpanel.functions.numeric import lenient_columns
from factpanel.operators.panel import latest_by_text
from factpanel.schema import PERIOD_COLS, SHEET_COLS

# Thresholds of the value screen.
REVENUE_FLOOR = 50_000_000.0
GROSS_MARGIN_FLOOR = 0.15
ROE_FLOOR = 0.10
FREE_CASH_FLOOR = 0.0
DEBT_TO_EQUITY_LIMIT = 2.0

TIE_COLS = ["adsh", *PERIOD_COLS]
RANKED_COLS = ["adsh", "cik", "name"]


def existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Projection to the listed columns that exist."""
    there = set(df.columns)
    return df.select(*[c for c in cols if c in there])


def _ties(df: DataFrame) -> list[Column]:
    """Order of equal values. The range shuffle of a full sort cuts on these too,
    so rows that share one value spread over several tasks."""
    there = set(df.columns)
    return [F.col(c).asc_nulls_last() for c in TIE_COLS if c in there]


def _by(df: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    c = F.col(metric)
    first = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    return df.orderBy(first, *_ties(df))


def threshold_screen(
    df: DataFrame,
    min_revenue: float | None = None,
    min_net_margin: float | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Rows at or above each bound that is given; ``max_rows`` 0 or None keeps all."""
    if min_revenue is not None:
        df = df.where(F.col("revenue") >= float(min_revenue))
    if min_net_margin is not None:
        df = df.where(F.col("net_margin") >= float(min_net_margin))
    return df.orderBy(*_ties(df)).limit(max_rows) if max_rows else df


def revenue_screen(df: DataFrame) -> DataFrame:
    """Rows with revenue present and not negative, highest first."""
    if "revenue" not in df.columns:
        return df.limit(0)
    return _by(df.where(F.col("revenue") >= 0), "revenue")


def _value_rows(df: DataFrame, min_revenue: float) -> DataFrame:
    return df.where(
        (F.col("revenue") >= min_revenue)
        & (F.col("gross_margin") >= GROSS_MARGIN_FLOOR)
        & (F.col("roe") >= ROE_FLOOR)
        & (F.col("fcf_approx") >= FREE_CASH_FLOOR)
    )


def value_screen(df: DataFrame, min_revenue: float = REVENUE_FLOOR) -> DataFrame:
    """Value screen over all filings, by ROE descending."""
    cols = ["revenue", "gross_margin", "net_margin", "roe", "roa", "debt_to_equity", "fcf_approx"]
    return _by(_value_rows(lenient_columns(df, cols), min_revenue), "roe")


def value_screen_latest(df: DataFrame, min_revenue: float = REVENUE_FLOOR) -> DataFrame:
    """Value screen, with a debt limit, over the latest filing of each company."""
    cols = ["revenue", "gross_margin", "roe", "debt_to_equity", "fcf_approx"]
    rows = latest_by_text(lenient_columns(df, cols))
    rows = _value_rows(rows, min_revenue).where(F.col("debt_to_equity") < DEBT_TO_EQUITY_LIMIT)
    return _by(rows, "roe")


def rank_by(df: DataFrame, metric: str, top_n: int = 20, ascending: bool = False) -> DataFrame:
    """Top rows by any metric, missing left out (take-ordered, no full sort)."""
    if metric not in df.columns:
        raise ValueError(f"no metric {metric!r}")
    rows = lenient_columns(df, [metric]).where(F.col(metric).isNotNull())
    return _by(rows, metric, ascending).limit(top_n)


def leading_rows(df: DataFrame, metrics: list[str], top_n: int, ties: list[str]) -> DataFrame:
    """Of each task the rows that are among its ``top_n`` highest or lowest by one of the
    metrics (doubles). A task holds these and one batch, and sorts only what ties."""

    def leading(table: pa.Table) -> pa.Table:
        chosen = []
        for m in metrics:
            column = table.column(m)
            values = column.to_numpy()
            there = np.flatnonzero(column.is_valid().to_numpy())
            for sign in (-1, 1):
                at, keys = there, sign * values[there]
                if len(at) > top_n:
                    last = np.partition(keys, top_n - 1)[top_n - 1]
                    chosen.append(at[keys < last])
                    at = at[keys == last]
                    if (more := top_n - len(chosen[-1])) < len(at) and ties:
                        order = pc.sort_indices(table.select(ties).take(at), [(c, "ascending") for c in ties], null_placement="at_end")
                        at = at[order.to_numpy()]
                    at = at[:more]
                chosen.append(at)
        return table.take(np.unique(np.concatenate(chosen)))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = leading(rows if held is None else pa.concat_tables([held, rows]))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return df.mapInArrow(of_task, df.schema)


def rank_all(df: DataFrame, metrics: list[str], top_n: int = 20, keep: list[str] = RANKED_COLS) -> DataFrame:
    """(metric, direction, rank, value, and the columns of `keep` that exist): the highest and the
    lowest rows by each metric, what `rank_by` gives for one, from one pass over ``df``.

    A task first drops the rows that lead by no metric. Every other row becomes one row for
    each metric it has, and direction. Spark puts the limit of a group below the shuffle too, so
    that a task sorts and sends ``top_n`` rows of each metric and direction, whatever the size
    of ``df``.
    """
    if missing := [m for m in metrics if m not in df.columns]:
        raise ValueError(f"no metrics {missing!r}")
    rows = lenient_columns(df, metrics)
    kept = [c for c in keep if c in df.columns]
    tied = [c for c in TIE_COLS if c in df.columns]
    if metrics and top_n > 0:
        rows = leading_rows(rows.select(*dict.fromkeys([*kept, *tied, *metrics])), list(dict.fromkeys(metrics)), top_n, tied)
    values = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    rows = rows.select(F.struct(*kept, *[c for c in tied if c not in kept]).alias("row"), F.explode(F.array(*values)).alias("m"))
    rows = rows.where("m.value IS NOT NULL").select("row", "m.metric", "m.value", F.explode(F.array(F.lit("high"), F.lit("low"))).alias("direction"))
    ties = [F.col(f"row.{c}").asc_nulls_last() for c in tied]
    key = F.when(F.col("direction") == "high", -F.col("value")).otherwise(F.col("value"))
    rank = F.row_number().over(Window.partitionBy("metric", "direction").orderBy(key, *ties))
    ranked = rows.withColumn("rank", rank).where(F.col("rank") <= top_n)
    return ranked.select("metric", "direction", "rank", "value", *[F.col(f"row.{c}").alias(c) for c in kept])


def top_revenue(df: DataFrame, n: int = 500) -> DataFrame:
    """Top rows by revenue; rows without revenue come last but stay."""
    return _by(lenient_columns(df, ["revenue"]), "revenue").limit(n)


def sheet_subset(df: DataFrame, n: int | None = 10) -> DataFrame:
    """The display columns with numeric ones cast, top ``n`` by revenue (None: all)."""
    text = ["name", "cik", "fy", "fp"]
    numeric = [c for c in SHEET_COLS if c not in text]
    rows = lenient_columns(df, numeric)
    if "revenue" in rows.columns:
        rows = _by(rows, "revenue")
    if n:
        rows = rows.limit(n)
    return existing(rows, SHEET_COLS)


def company_rows(df: DataFrame, cik: int | None = None, name: str | None = None) -> DataFrame:
    """Rows of one company, by id or by name."""
    if cik is not None:
        df = df.where(F.col("cik") == cik)
    if name is not None:
        df = df.where(F.col("name") == name)
    return df


def distinct_companies(df: DataFrame) -> DataFrame:
    return df.select("name").distinct()


def companies_with_filings(df: DataFrame, at_least: int = 4) -> DataFrame:
    """Companies with at least that many rows, and how many."""
    counts = df.where(F.col("cik").isNotNull()).groupBy("cik").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= at_least)
