"""Two companies side by side, and the profit-and-loss bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.functions.numeric import lenient_columns, nan_to_null
from factpanel.operators.panel import latest_by_rank
from factpanel.schema import COMPARE_METRICS


def transpose(df: DataFrame, key: str, heads: dict[str, object], cols: list[str]) -> DataFrame:
    """Columns become rows: one row per column name, one column per key value.

    ``heads`` gives the key value of each new column, so the shape is fixed.
    """
    long = df.unpivot([key], cols, "metric", "value")
    return long.groupBy("metric").agg(
        *[F.max(F.when(F.col(key) == k, F.col("value"))).alias(h) for h, k in heads.items()]
    )


def compare_companies(
    df: DataFrame,
    first: int,
    second: int,
    metrics: list[str] | None = None,
    check: bool = True,
) -> DataFrame:
    """Latest filing of two companies, one row per metric, in the order given.

    A metric that is no column gives a row of nulls.
    """
    metrics = list(metrics or COMPARE_METRICS)
    rows = df.where(F.col("cik").isin(first, second))
    if check:
        for cik in (first, second):
            if rows.where(F.col("cik") == cik).isEmpty():
                raise ValueError(f"no rows of company {cik}")
    known = [m for m in metrics if m in df.columns]
    latest = lenient_columns(latest_by_rank(rows), known)
    missing = {m: F.lit(None).cast("double") for m in metrics if m not in known}
    if missing:
        latest = latest.withColumns(missing)
    heads = {f"CIK {first}": first, f"CIK {second}": second}
    wide = transpose(latest.select("cik", *metrics), "cik", heads, metrics)
    place = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric"))
    return wide.orderBy(place).withColumnRenamed("metric", "Metric")


def _step(label: str, value: Column, measure: str) -> Column:
    return F.struct(
        F.lit(label).alias("step"),
        F.nanvl(value, F.lit(None).cast("double")).alias("value"),
        F.lit(measure).alias("measure"),
    )


def profit_bridge(df: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue, then the relative steps down to net income, one row per step.

    Gross profit and operating income come from their margins and are left out
    when the margin is missing; each step is measured from the last one present.
    """
    cols = ["revenue", "net_income", "gross_margin", "operating_margin"]
    rows = lenient_columns(df, cols)
    revenue, net = F.col("revenue"), F.col("net_income")
    has_gross = F.col("gross_margin").isNotNull()
    has_operating = F.col("operating_margin").isNotNull()
    gross = nan_to_null("revenue * gross_margin")
    operating = nan_to_null("revenue * operating_margin")
    before_operating = F.when(has_gross, gross).otherwise(revenue)
    before_net = F.when(has_operating, operating).otherwise(before_operating)
    steps = F.array(
        _step("Revenue", revenue, "absolute"),
        F.when(has_gross, _step("Gross Profit", gross - revenue, "relative")),
        F.when(has_operating, _step("Operating Income", operating - before_operating, "relative")),
        _step("Net Income", net - before_net, "relative"),
    )
    placed = rows.select(*keys, F.posexplode(F.array_compact(steps)).alias("position", "s"))
    return placed.select(*keys, "position", "s.step", "s.value", "s.measure")
