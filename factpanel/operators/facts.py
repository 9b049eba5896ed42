"""Long facts to one wide row per filing, with ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.functions.numeric import (
    lenient_double,
    nan_to_null,
    quoted,
    safe_ratio,
    text_literals,
    to_double,
)
from factpanel.schema import DEFAULT_FORMS, DEFAULT_TAGS, RATIOS, filing_keys


def filter_forms(sub: DataFrame, forms: list[str] | None = None) -> DataFrame:
    """Filings whose form is in the list. Exact match: amendments fall out."""
    return sub.where(F.col("form").isin(list(forms or DEFAULT_FORMS)))


def scan_typed(sub: DataFrame, strict: bool = True) -> DataFrame:
    """Company id and period as bigint. Strict casts raise on bad text under ANSI."""
    cols = [c for c in ("cik", "period") if c in sub.columns]
    if strict:
        return sub.withColumns({c: F.col(c).cast("bigint") for c in cols})
    return sub.withColumns({c: F.col(c).try_cast("bigint") for c in cols})


def _join_key(df: DataFrame, keys: list[str], spread_nulls: bool) -> Column:
    """One text that names a filing.

    The key is derived, so both join inputs get an exchange of their own right
    below the join. That is the shape in which AQE can split a hot partition; a
    join that reuses the partitioning of an aggregation is never split. A null
    part matches nothing, so such rows get a key of their own each instead of
    meeting in one task.
    """
    names = [quoted(k) for k in keys]
    text = f"concat_ws('|', {', '.join(f'CAST({k} AS STRING)' for k in names)})"
    if not spread_nulls:
        return F.expr(text)
    missing = " OR ".join(f"{k} IS NULL" for k in names)
    row_hash = f"xxhash64({', '.join(quoted(c) for c in df.columns)})"
    return F.expr(f"CASE WHEN {missing} THEN concat('null|', {row_hash}) ELSE {text} END")


def with_known_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with all keys; plain null checks reach the scan, ``dropna`` would not."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def join_per_filing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a table with at most one row per filing; every left row stays."""
    extra = [c for c in right.columns if c not in keys]
    left = left.withColumn("_filing", _join_key(left, keys, spread_nulls=True))
    right = with_known_keys(right, keys)
    right = right.select(_join_key(right, keys, spread_nulls=False).alias("_filing"), *extra)
    return left.join(right, "_filing", "left").drop("_filing")


def filings_not_in(filings: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Left anti join: rows whose filing is not listed; a null key is never listed.

    Listed filings are made distinct on the map side first, so that facts, with
    many rows per filing, can be passed as they are.
    """
    left = filings.withColumn("_filing", _join_key(filings, keys, spread_nulls=True))
    right = with_known_keys(listed, keys).select(*keys).distinct()
    right = right.select(_join_key(right, keys, spread_nulls=False).alias("_filing"))
    return left.join(right, "_filing", "left_anti").drop("_filing")


def facts_of_filings(num: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts of the given filings (left semi join; the keys are never collected).

    The filings need no ``distinct``: a semi join stops at the first match, and
    without an aggregation below it AQE may split hot filings on the fact side.
    """
    keys = filing_keys(num, filings)
    return num.join(filings.select(*keys), keys, "left_semi")


def tag_pivot(
    num: DataFrame,
    tags: dict[str, list[str]] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Per filing, the largest value over the tags of each metric, in one pass.

    Facts with other tags are dropped before the shuffle, and ``max`` combines on
    the map side, so even a filing with a third of all facts sends one row per
    task. Filings without any of the tags give no row; join from the filings.
    """
    tags = tags or DEFAULT_TAGS
    keys = filing_keys(num)
    wanted = sorted({t for names in tags.values() for t in names})
    value = to_double("value") if strict else lenient_double("value")
    facts = with_known_keys(num, keys).where(F.col("tag").isin(wanted))
    facts = facts.select(*keys, "tag", value.alias("value"))
    return facts.groupBy(*keys).agg(
        *[
            F.expr(f"max(CASE WHEN tag IN ({text_literals(names)}) THEN value END)").alias(metric)
            for metric, names in tags.items()
        ]
    )


def attach_facts(sub: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per filing row; filings without facts keep null metrics."""
    return join_per_filing(sub, facts, filing_keys(sub, facts))


def add_ratios(df: DataFrame) -> DataFrame:
    """The ten ratios, ``fcf_approx`` and ``fcf_to_net_income``."""
    made = {name: safe_ratio(a, b) for name, (a, b) in RATIOS.items()}
    made["fcf_approx"] = nan_to_null("cfo + cfi")
    made["fcf_to_net_income"] = safe_ratio("(cfo + cfi)", "net_income")
    return df.withColumns(made)


def build_fundamentals(
    sub: DataFrame,
    num: DataFrame,
    forms: list[str] | None = None,
    tags: dict[str, list[str]] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Wide rows with ratios for every period in the inputs, as one plan."""
    filings = filter_forms(sub, forms)
    return add_ratios(attach_facts(filings, tag_pivot(num, tags, strict)))
