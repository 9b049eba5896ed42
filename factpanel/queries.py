"""Registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factpanel import bindings as b
from factpanel.functions import ids, numeric
from factpanel.functions.display import format_display, format_numeric_columns
from factpanel.operators import audit, compare, facts, merge, panel, profile, quality, screens, unions
from factpanel.plans import updates
from factpanel.plans.fundamentals import fundamentals_of_companies, trailing_metric
from factpanel.plans.screening import simple_screener
from factpanel.schema import DELTA_COLS, PERIOD_COLS, RATIOS, SCREENER_TAGS, TTM_COLS, YOY_COLS
from factpanel.sources.tables import FactTables

Query = Callable[[SparkSession, str], DataFrame]

ID_COLS = ["adsh", "cik", "name", "form", "fy", "fp", "period", "filed", *PERIOD_COLS]
METRICS = list(b.TAGS)
RATIO_COLS = [*RATIOS, "fcf_approx", "fcf_to_net_income"]
BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
NO_COMPANY = "9999999999"
LINE_CATEGORIES = [
    ("license", r"(?i)licen[cs]e|copyright|all rights reserved", None),
    ("contact", r"@[A-Za-z0-9]", None),
    ("digits", r"[0-9]{4,}", ["en", "de"]),
    ("short", r"^\s*\S{1,12}\s*$", None),
]


def plain(df: DataFrame) -> DataFrame:
    """Infinite values as null, with their columns and signs beside them, so that rows of
    any engine can be compared by value."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    signs = [f"CASE WHEN {c} = {numeric.INF_SQL} THEN '{c}+' WHEN {c} = -{numeric.INF_SQL} THEN '{c}-' END" for c in doubles]
    made = {c: numeric.finite(c) for c in doubles}
    return df.withColumns({**made, "infinite": F.expr(f"concat_ws(',', {', '.join(signs)})")})


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return facts.build_fundamentals(b.sub(spark, sf), b.num(spark, sf), tags=b.TAGS)


def _series(spark: SparkSession, sf: str, build: panel.Build) -> DataFrame:
    filings = panel.place_in_companies(facts.filter_forms(b.sub(spark, sf)))
    return panel.over_companies(facts.build_fundamentals(filings, b.num(spark, sf), tags=b.TAGS), build)


def fundamentals(spark, sf):
    return plain(_panel(spark, sf))


def scan_typed(spark, sf):
    sub = b.sub(spark, sf)
    texts = {c: F.col(c).cast("string") for c in ("cik", "period")}
    return facts.scan_typed(sub.withColumns(texts)).select(*ID_COLS)


def table_loader(spark, sf):
    tables = FactTables(spark, sf)
    named = {t: tables.table(f"{t}.parquet") for t in BASE_TABLES}
    return quality.row_count_snapshot(named, by=[])


def period_list(spark, sf):
    periods = quality.periods_of(b.sub(spark, sf))
    return periods.withColumn("period_key", ids.period_key(*PERIOD_COLS))


def period_earliest(spark, sf):
    return quality.earliest_periods(b.sub(spark, sf), 4)


def period_key(spark, sf):
    sub = b.sub(spark, sf)
    rows = sub.select(
        "adsh",
        ids.period_key(*PERIOD_COLS).alias("key"),
        ids.period_label(*PERIOD_COLS).alias("label"),
    )
    year, quarter = ids.parse_period_key("key")
    return rows.withColumns({"year": year, "quarter": quarter})


def row_count_snapshot(spark, sf):
    return quality.row_count_snapshot({t: b.read(spark, sf, t) for t in BASE_TABLES}, by=[])


def row_count_by_period(spark, sf):
    return quality.row_count_snapshot({"sub": b.sub(spark, sf), "num": b.num(spark, sf)})


def filter_forms(spark, sf):
    return facts.filter_forms(b.sub(spark, sf)).select(*ID_COLS)


def facts_semi_join(spark, sf):
    filings = facts.filter_forms(b.sub(spark, sf))
    rows = facts.facts_of_filings(b.num(spark, sf), filings)
    return rows.select("adsh", "tag", "value", "ddate")


def lenient_numeric(spark, sf):
    events = b.read(spark, sf, "events")
    mixed = F.when(F.col("event_type") == "error", F.col("props"))
    texts = events.select(
        "event_id",
        F.col("value").cast("string").alias("amount"),
        mixed.otherwise(F.col("value").cast("string")).alias("mixed"),
        F.regexp_extract("props", r"([0-9]+)", 1).alias("k"),
        F.col("event_type").alias("label"),
    )
    return numeric.lenient_columns(texts, ["amount", "mixed", "k", "label", "absent"])


def tag_pivot(spark, sf):
    return facts.tag_pivot(b.num(spark, sf), b.TAGS).select("adsh", *METRICS)


def filing_facts_left(spark, sf):
    filings = facts.filter_forms(b.sub(spark, sf))
    rows = facts.attach_facts(filings, facts.tag_pivot(b.num(spark, sf), b.TAGS))
    return rows.select("adsh", "cik", "form", *METRICS)


def ratios(spark, sf):
    return plain(_panel(spark, sf).select("adsh", *RATIO_COLS))


def panel_build(spark, sf):
    label = ids.period_label(*PERIOD_COLS).alias("label")
    return _panel(spark, sf).select("adsh", "cik", *PERIOD_COLS, label, *METRICS)


def panel_yoy(spark, sf):
    rows = _series(spark, sf, panel.yoy_columns())
    return plain(rows.select("adsh", "cik", *[f"{c}_yoy" for c in YOY_COLS]))


def _ttm_names():
    return [*[f"ttm_{c}" for c in TTM_COLS], "ttm_net_margin"]


def panel_ttm(spark, sf):
    return plain(_series(spark, sf, panel.ttm_columns()).select("adsh", "cik", *_ttm_names()))


def panel_ttm_yoy(spark, sf):
    names = [f"{c}_yoy" for c in panel.TTM_YOY_COLS]
    return plain(_series(spark, sf, panel.ttm_yoy_columns()).select("adsh", "cik", *names))


def panel_delta(spark, sf):
    rows = _series(spark, sf, panel.delta_columns())
    return plain(rows.select("adsh", "cik", *[f"{c}_delta" for c in DELTA_COLS]))


def panel_full(spark, sf):
    return plain(_series(spark, sf, panel.panel_columns()))


def company_ttm(spark, sf):
    first = b.read(spark, sf, "supplier").agg(F.min("s_suppkey")).first()[0]
    return trailing_metric(b.sub(spark, sf), b.num(spark, sf), first, "revenue", tags=b.TAGS)


def simple_screener_query(spark, sf):
    sub, num = b.sub(spark, sf), b.num(spark, sf, by_brand=True)
    return plain(simple_screener(sub, num, min_revenue=b.FLOOR, tags=b.MERGE_TAGS))


def screener_merge(spark, sf):
    num = b.num(spark, sf, by_brand=True)
    return plain(merge.merge_metrics(b.sub(spark, sf), num, tags=b.MERGE_TAGS))


def screener_collapse(spark, sf):
    tags = {m: b.TAGS[m][0] for m in SCREENER_TAGS}
    sub, num = b.sub(spark, sf), b.num(spark, sf)
    return plain(simple_screener(sub, num, b.FLOOR, 0.2, tags=tags, collapse="max"))


def screen_revenue(spark, sf):
    return screens.revenue_screen(_panel(spark, sf)).select("adsh", "name", "revenue")


def value_screen_all(spark, sf):
    rows = screens.value_screen(_panel(spark, sf), b.FLOOR)
    return plain(rows.select("adsh", "revenue", "gross_margin", "roe", "fcf_approx"))


def value_screen_latest(spark, sf):
    rows = screens.value_screen_latest(_panel(spark, sf), b.FLOOR)
    cols = ["name", "fy", "fp", "revenue", "gross_margin", "roe", "debt_to_equity", "fcf_approx"]
    return plain(rows.select("adsh", *cols))


def latest_by_text(spark, sf):
    return panel.latest_by_text(_panel(spark, sf)).select("cik", "adsh", "fy", "fp", "revenue")


def latest_by_rank(spark, sf):
    return panel.latest_by_rank(_panel(spark, sf)).select("cik", "adsh", "fy", "fp", "revenue")


def top_revenue(spark, sf):
    return screens.top_revenue(_panel(spark, sf), 500).select("adsh", "name", "revenue")


def rank_metric(spark, sf):
    rows = screens.rank_by(_panel(spark, sf), "roe", 20)
    return plain(rows.select("adsh", "name", "roe", "revenue", "net_income", "fcf_approx"))


def rank_metric_low(spark, sf):
    rows = screens.rank_by(_panel(spark, sf), "net_margin", 15, ascending=True)
    return plain(rows.select("adsh", "name", "net_margin", "revenue"))


def rank_all_metrics(spark, sf):
    """The 20 highest and lowest filings by each of 24 metrics."""
    return plain(screens.rank_all(_panel(spark, sf), [*METRICS, *RATIO_COLS], 20))


def excel_subset(spark, sf):
    return plain(screens.sheet_subset(_panel(spark, sf), 10))


def compare_companies(spark, sf):
    ends = b.read(spark, sf, "supplier").agg(F.min("s_suppkey"), F.max("s_suppkey")).first()
    rows = fundamentals_of_companies(b.sub(spark, sf), b.num(spark, sf), list(ends), tags=b.TAGS)
    rows = compare.compare_companies(rows, *ends, check=False)
    return plain(rows.toDF("metric", "first_company", "second_company"))


def absent_filings(spark, sf):
    rows = audit.filings_without_facts(b.customer_sub(spark, sf), b.customer_num(spark, sf))
    return rows.select("adsh", "cik", "form", "filed", *PERIOD_COLS)


def _known(spark, sf, table="supplier", key="s_suppkey") -> dict[str, str]:
    """Two companies of the table, and one that does not exist."""
    ends = b.read(spark, sf, table).agg(F.min(key), F.max(key)).first()
    return {
        "First": str(ends[0]).zfill(10),
        "Last": str(ends[1]).zfill(10),
        "Nobody": NO_COMPANY,
    }


def coverage_classify(spark, sf):
    """Facts without a value count as not usable."""
    known = _known(spark, sf, "customer", "c_custkey")
    return audit.classify_coverage(b.customer_sub(spark, sf), b.customer_num(spark, sf), known)


def distinct_companies(spark, sf):
    return screens.distinct_companies(b.sub(spark, sf))


def form_counts(spark, sf):
    sub = b.sub(spark, sf)
    shown = F.when(F.col("form") != "8-K", F.col("form"))
    return audit.form_counts(sub.withColumn("form", shown))


def companies_min_filings(spark, sf):
    return screens.companies_with_filings(facts.filter_forms(b.sub(spark, sf)), 26)


def audit_cik_counts(spark, sf):
    presence = audit.company_presence(b.customer_sub(spark, sf), b.customer_num(spark, sf))
    return audit.company_counts(presence)


def quarter_audit(spark, sf):
    rows = audit.audit_quarters(b.sub(spark, sf), b.num(spark, sf), _known(spark, sf))
    return rows.drop(*PERIOD_COLS)


def normalize_id(spark, sf):
    key = F.col("c_custkey")
    text = key.cast("string")
    shaped = (
        F.when(key % 5 == 0, F.concat(text, F.lit(".0")))
        .when(key % 5 == 1, F.concat(F.lit("CIK"), text))
        .when(key % 5 == 2, F.concat(F.lit("10000000000"), text))
        .when(key % 5 == 3, F.concat(F.lit("no id "), F.col("c_mktsegment")))
        .when(key % 7 != 0, text)
    )
    rows = b.read(spark, sf, "customer").select("c_custkey", shaped.alias("raw"))
    return rows.withColumn("id", ids.normalize_id("raw"))


def _join_text(c: str):
    return F.concat_ws(",", c).alias(c)


def _event_periods(spark, sf) -> DataFrame:
    """Quarters of the events: nothing was shipped in some of them, so their tables are missing."""
    day = {"dataset_year": F.year("ts").cast("int"), "dataset_quarter": F.quarter("ts").cast("int")}
    return b.read(spark, sf, "events").select(*[c.alias(n) for n, c in day.items()]).distinct()


def sub_integrity(spark, sf):
    sub = b.sub(spark, sf)
    holes = sub.withColumns(
        {
            "cik": F.when(~((F.col("form") == "8-K") & (F.col("fy") % 2 == 0)), F.col("cik")),
            "name": F.when(F.col("dataset_quarter") != 3, F.col("name")),
        }
    )
    rows = quality.sub_integrity(holes, _event_periods(spark, sf))
    return rows.select(*PERIOD_COLS, "status", _join_text("issues"), _join_text("warnings"))


def num_integrity(spark, sf):
    rows = quality.num_integrity(b.num(spark, sf), _event_periods(spark, sf))
    counts = ["null_value_count", "null_ddate_count"]
    return rows.select(*PERIOD_COLS, "status", _join_text("issues"), *counts)


def validate_panel(spark, sf):
    checked = quality.validate_panel(_series(spark, sf, panel.ttm_columns()))
    return checked.select("status", F.concat_ws(" ", "errors").alias("errors"), "n_rows")


def _observed(spark, sf) -> DataFrame:
    """(period, table, bytes) seen in the orders, with some tables taken out."""
    orders = b.read(spark, sf, "orders")
    kind = F.substring("o_orderpriority", 1, 1)
    table = (
        F.when(kind == "1", F.lit("sub")).when(kind == "2", F.lit("num"))
        .when(kind == "3", F.lit("pre")).when(kind == "4", F.lit("tag"))
        .otherwise(F.lit("txt"))
    )
    rows = orders.select(
        F.year("o_orderdate").cast("int").alias("dataset_year"),
        F.quarter("o_orderdate").cast("int").alias("dataset_quarter"),
        table.alias("table"),
        F.floor("o_totalprice").alias("bytes"),
    )
    year, quarter = F.col("dataset_year"), F.col("dataset_quarter")
    gone = ((F.col("table") == "pre") & (quarter == 2)) | ((F.col("table") == "tag") & (year % 3 == 0))
    return rows.where(~gone)


def period_completeness(spark, sf):
    rows = quality.period_completeness(_observed(spark, sf), min_bytes=1)
    return rows.withColumn("missing_files", F.concat_ws(",", "missing_files"))


def check_report(spark, sf):
    sub, num = b.sub(spark, sf), b.num(spark, sf)
    rows = quality.check_report(
        completeness=quality.period_completeness(_observed(spark, sf)),
        sub_checks=quality.sub_integrity(sub),
        num_checks=quality.num_integrity(num),
        counts=quality.row_count_snapshot({"sub": sub, "num": num}),
    )
    meta = F.array_sort(F.transform(F.map_entries("meta"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return rows.select(
        "check", "period", "status", _join_text("issues"), F.concat_ws(";", meta).alias("meta")
    )


def profile_columns(spark, sf):
    rows = profile.profile_columns(plain(_panel(spark, sf)))
    shown = {c: F.round(c, 4) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")}
    counts = {c: F.col(c).cast("double") for c in ("count", "unique", "freq")}
    return rows.withColumns({**shown, **counts})


def histogram_2d(spark, sf):
    return profile.histogram_2d(_panel(spark, sf), "roe", "roa")


def union_by_name(spark, sf):
    """Periodic and current reports: one lacks a column, another has it as text."""
    sub = b.sub(spark, sf)
    periodic = facts.filter_forms(sub).select("adsh", "cik", "fy", "filed")
    current = facts.filter_forms(sub, ["8-K"])
    current = current.select("adsh", "cik", F.concat(F.lit("FY"), F.col("fy")).alias("fy"), "form")
    return unions.union_by_name(periodic, current)


def union_distinct(spark, sf):
    """All filings, then the annual ones again with the segment column missing."""
    sub = b.sub(spark, sf).select("cik", "form", "fy", "fp")
    again = facts.filter_forms(sub, ["10-K", "8-K"])
    return unions.union_distinct(sub, again, sub.select("cik", "form", "fy"))


def month_rollup(spark, sf):
    """Orders as month releases, the finished ones delivered twice."""
    orders = b.read(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
    )
    again = orders.where(F.col("o_orderstatus") == "F")
    return unions.months_to_quarters(unions.union_by_name(orders, again))


def month_quarter(spark, sf):
    day = F.col("o_orderdate")
    rows = b.read(spark, sf, "orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"), day.alias("day")
    )
    next_year, next_month = ids.next_month("year", "month")
    back_year, back_month = ids.month_before("day")
    return rows.withColumns(
        {
            "quarter": ids.quarter_of_month("month"),
            "next_year": next_year,
            "next_month": next_month,
            "back_year": back_year,
            "back_month": back_month,
        }
    ).drop("day")


def fundamentals_lenient(spark, sf):
    """Text columns throughout, some of which hold no number."""
    sub, num = b.sub(spark, sf), b.num(spark, sf)
    texts = {c: F.col(c).cast("string") for c in ("cik", "period", "fy")}
    public = F.when(F.col("fy") % 2 == 0, F.concat(F.col("period").cast("string"), F.lit(".5"))).otherwise("n/a")
    sub = facts.scan_typed(sub.withColumn("pubfloatusd", public).withColumns(texts), strict=False)
    num = num.withColumn("value", F.col("value").cast("string"))
    rows = facts.build_fundamentals(sub, num, tags=b.TAGS, strict=False)
    rows = numeric.lenient_columns(rows, [*METRICS, *RATIO_COLS, "pubfloatusd", "absent"])
    return plain(rows.select("adsh", "cik", "fy", "pubfloatusd", *METRICS, *RATIO_COLS))


def panel_sorted(spark, sf):
    return panel.sort_panel(_panel(spark, sf)).select("adsh", "cik", *PERIOD_COLS, *METRICS)


def company_by_name(spark, sf):
    name = b.read(spark, sf, "supplier").agg(F.max("s_name")).first()[0]
    return screens.company_rows(_panel(spark, sf), name=name).select(*ID_COLS, *METRICS)


def sheet_of_periods(spark, sf):
    """Years and quarters are paired up; the shorter list decides."""
    ends = b.sub(spark, sf).agg(F.min("fy"), F.max("fy")).first()
    pairs = list(zip([ends[0], ends[0] + 1, ends[1]], [3, 1], strict=False))
    sub, num = (quality.in_periods(t, pairs) for t in (b.sub(spark, sf), b.num(spark, sf)))
    return plain(screens.sheet_subset(facts.build_fundamentals(sub, num, tags=b.TAGS), None))


def incremental_month(spark, sf):
    """Orders as deliveries of tables by month; the stored state is the earliest month."""
    orders = b.read(spark, sf, "orders")
    day, first = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    table = F.when(first == "1", "sub").when(first == "2", "num").when(first == "3", "pre").when(first == "4", "tag")
    observed = orders.select(F.year(day).alias("year"), F.month(day).alias("month"), table.alias("table"))
    state = orders.agg(F.min(day).alias("day")).select(F.year("day").alias("year"), F.month("day").alias("month"))
    return updates.advanced(observed, state)


def format_display_query(spark, sf):
    balance = F.col("c_acctbal")
    rows = b.read(spark, sf, "customer")
    return rows.select(
        "c_custkey",
        format_display(balance / 16384).alias("ratio"),
        format_display(balance).alias("plain"),
        format_display(balance * 4097).alias("millions"),
        format_display(balance * 2097169).alias("billions"),
    )


def format_columns(spark, sf):
    balance = F.col("c_acctbal")
    rows = b.read(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        "c_mktsegment",
        balance.alias("plain"),
        (balance * 4097).alias("millions"),
        (balance * 2097169).alias("billions"),
        "c_nationkey",
    )
    return format_numeric_columns(rows)


def pl_bridge(spark, sf):
    rows = panel.first_by_name(_panel(spark, sf))
    return compare.profit_bridge(rows, ["name"])


def line_findings(spark, sf):
    documents = b.read(spark, sf, "documents")
    return audit.classify_lines(documents, "text", ["doc_id"], LINE_CATEGORIES, group="lang")


def queries() -> dict[str, Query]:
    return {
        "fundamentals": fundamentals,
        "scan_typed": scan_typed,
        "table_loader": table_loader,
        "period_list": period_list,
        "period_earliest": period_earliest,
        "period_key": period_key,
        "row_count_snapshot": row_count_snapshot,
        "row_count_by_period": row_count_by_period,
        "filter_forms": filter_forms,
        "facts_semi_join": facts_semi_join,
        "lenient_numeric": lenient_numeric,
        "tag_pivot": tag_pivot,
        "filing_facts_left": filing_facts_left,
        "ratios": ratios,
        "panel_build": panel_build,
        "panel_yoy": panel_yoy,
        "panel_ttm": panel_ttm,
        "panel_ttm_yoy": panel_ttm_yoy,
        "panel_delta": panel_delta,
        "panel_full": panel_full,
        "company_ttm": company_ttm,
        "simple_screener": simple_screener_query,
        "screener_merge": screener_merge,
        "screener_collapse": screener_collapse,
        "screen_revenue": screen_revenue,
        "value_screen_all": value_screen_all,
        "value_screen_latest": value_screen_latest,
        "latest_by_text": latest_by_text,
        "latest_by_rank": latest_by_rank,
        "top_revenue": top_revenue,
        "rank_metric": rank_metric,
        "rank_metric_low": rank_metric_low,
        "rank_all_metrics": rank_all_metrics,
        "excel_subset": excel_subset,
        "compare_companies": compare_companies,
        "absent_filings": absent_filings,
        "coverage_classify": coverage_classify,
        "distinct_companies": distinct_companies,
        "form_counts": form_counts,
        "companies_min_filings": companies_min_filings,
        "audit_cik_counts": audit_cik_counts,
        "quarter_audit": quarter_audit,
        "normalize_id": normalize_id,
        "sub_integrity": sub_integrity,
        "num_integrity": num_integrity,
        "validate_panel": validate_panel,
        "period_completeness": period_completeness,
        "check_report": check_report,
        "profile_columns": profile_columns,
        "histogram_2d": histogram_2d,
        "union_by_name": union_by_name,
        "union_distinct": union_distinct,
        "month_rollup": month_rollup,
        "month_quarter": month_quarter,
        "incremental_month": incremental_month,
        "fundamentals_lenient": fundamentals_lenient,
        "panel_sorted": panel_sorted,
        "company_by_name": company_by_name,
        "sheet_of_periods": sheet_of_periods,
        "format_display": format_display_query,
        "format_columns": format_columns,
        "pl_bridge": pl_bridge,
        "line_findings": line_findings,
    }
