"""Coverage audit: which companies a release holds, and how usable their facts are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.functions.ids import normalize_id, period_key
from factpanel.functions.numeric import lenient_double, quoted
from factpanel.operators.facts import filings_not_in, join_per_filing, with_known_keys
from factpanel.operators.quality import periods_of
from factpanel.schema import KNOWN_COMPANIES, PERIOD_COLS, filing_keys

# Classes of a known company in one period.
ABSENT_SUB = "absent_from_sub"
ABSENT_NUM = "absent_from_num"
NOT_USABLE = "present_in_num_but_not_usable"
USABLE = "usable_numeric_rows_present"


def _count_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def facts_per_filing(num: DataFrame, keys: list[str]) -> DataFrame:
    """Facts and usable facts per filing: a big filing combines on the map side."""
    usable = F.count_if(lenient_double("value").isNotNull()) if "value" in num.columns else F.lit(0)
    rows = with_known_keys(num, keys).groupBy(*keys)
    return rows.agg(_count_rows("n_facts"), usable.cast("bigint").alias("n_usable"))


def company_presence(
    sub: DataFrame | None, num: DataFrame | None, companies: list[str] | None = None
) -> DataFrame | None:
    """Per period and company: filings, facts and usable facts.

    Facts are read once and reduced to filings on the map side before they meet
    the headers; ``companies`` limits the filings to those normalised ids. None if
    there are no headers to take companies from.
    """
    if sub is None or "cik" not in sub.columns:
        return None
    filings = sub if "adsh" in sub.columns else sub.withColumn("adsh", F.lit(None).cast("string"))
    filings = filings.withColumn("company", normalize_id("cik"))
    if companies is not None:
        filings = filings.where(F.col("company").isin(list(companies)))
    filings = filings.groupBy(*PERIOD_COLS, "adsh", "company").agg(_count_rows("n_filings"))
    if num is None or "adsh" not in num.columns:
        zero = F.lit(0).cast("bigint")
        rows = filings.withColumns({"n_facts": zero, "n_usable": zero})
    else:
        keys = filing_keys(filings, num)
        rows = join_per_filing(filings, facts_per_filing(num, keys), keys)
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_filings", "n_facts", "n_usable")]
    return rows.groupBy(*PERIOD_COLS, "company").agg(*total)


def company_counts(presence: DataFrame) -> DataFrame:
    """Distinct companies per period, among the filings and among the facts."""
    known = F.col("company").isNotNull()
    return presence.groupBy(*PERIOD_COLS).agg(
        F.count_if(known).alias("distinct_cik_count_in_sub"),
        F.count_if(known & (F.col("n_facts") > 0)).alias("distinct_cik_count_in_num"),
    )


def form_counts(sub: DataFrame) -> DataFrame:
    """Filings per period and form; a null form counts as ``<null>``."""
    form = F.coalesce(F.col("form").cast("string"), F.lit("<null>")).alias("form")
    return sub.groupBy(*PERIOD_COLS, form).agg(_count_rows("n"))


def form_counts_json(sub: DataFrame) -> DataFrame:
    """Rows of a period, and its form counts as JSON text with sorted keys.

    The map has one entry per kind of form, not per filing.
    """
    entries = F.array_sort(F.collect_list(F.struct("form", "n")))
    made = F.to_json(F.map_from_entries(entries)).alias("form_counts_json")
    total = F.sum("n").alias("sub_row_count")
    return form_counts(sub).groupBy(*PERIOD_COLS).agg(total, made)


FLAGS = {"in_sub": "n_filings", "in_num": "n_facts", "usable": "n_usable"}


def _known_flags(presence: DataFrame | None, periods: DataFrame, known: dict[str, str]) -> DataFrame:
    """Periods with an array of (known, company, flags), one entry per known company.

    The list is an argument of fixed size, so every company is a few conditional
    aggregates of one pass; nothing is joined to or crossed with the list.
    """

    def flag(company: str, count: str) -> Column:
        return F.bool_or((F.col("company") == company) & (F.col(count) > 0))

    if presence is None:
        rows = periods.select(*PERIOD_COLS)
    else:
        measures = [
            flag(company, count).alias(f"{name}|{f}")
            for name, company in known.items()
            for f, count in FLAGS.items()
        ]
        found = presence.groupBy(*PERIOD_COLS).agg(*measures)
        rows = periods.select(*PERIOD_COLS).join(found, PERIOD_COLS, "left")

    def entry(name: str, company: str) -> Column:
        no = F.lit(False)
        flags = {
            f: no if presence is None else F.coalesce(F.col(quoted(f"{name}|{f}")), no) for f in FLAGS
        }
        classed = (
            F.when(flags["usable"], F.lit(USABLE))
            .when(flags["in_num"], F.lit(NOT_USABLE))
            .when(flags["in_sub"], F.lit(ABSENT_NUM))
            .otherwise(F.lit(ABSENT_SUB))
        )
        return F.struct(
            F.lit(name).alias("known"),
            F.lit(company).alias("company"),
            *[c.alias(f) for f, c in flags.items()],
            classed.alias("classification"),
        )

    entries = [entry(name, company) for name, company in sorted(known.items())]
    return rows.select(*PERIOD_COLS, F.array(*entries).alias("known"))


def _all_periods(*tables: DataFrame | None) -> DataFrame:
    """Periods of any of the tables; only partition columns are read."""
    frames = [periods_of(t) for t in tables if t is not None]
    return reduce(DataFrame.union, frames).distinct()


def classify_coverage(
    sub: DataFrame | None,
    num: DataFrame | None,
    known: dict[str, str] | None = None,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Class of every known company in every period."""
    known = known or KNOWN_COMPANIES
    periods = _all_periods(sub, num) if periods is None else periods
    presence = company_presence(sub, num, sorted(set(known.values())))
    rows = _known_flags(presence, periods, known)
    return rows.select(*PERIOD_COLS, F.explode("known").alias("k")).select(*PERIOD_COLS, "k.*")


def filings_without_facts(sub: DataFrame, num: DataFrame) -> DataFrame:
    """Filings that no fact names."""
    return filings_not_in(sub, num, filing_keys(sub, num))


def audit_quarters(
    sub: DataFrame | None,
    num: DataFrame | None,
    known: dict[str, str] | None = None,
    tables: DataFrame | None = None,
) -> DataFrame:
    """One row per period: sizes, companies, forms, and the known companies.

    ``tables`` lists the (period, table) pairs that exist; without it a table
    exists for the periods it has rows of. Facts are read in one pass; counting
    their rows per period takes the partition columns only.
    """
    known = known or KNOWN_COMPANIES
    null = F.lit(None)
    periods = _all_periods(sub, num) if tables is None else tables.select(*PERIOD_COLS).distinct()
    presence = company_presence(sub, num)
    rows = _known_flags(presence, periods, known)

    if presence is None:
        counts = {f"distinct_cik_count_in_{t}": null.cast("bigint") for t in ("sub", "num")}
        rows = rows.withColumns(counts)
    else:
        rows = rows.join(company_counts(presence), PERIOD_COLS, "left")
    if sub is None:
        rows = rows.withColumns(
            {"sub_row_count": null.cast("bigint"), "form_counts_json": null.cast("string")}
        )
    elif "form" in sub.columns:
        rows = rows.join(form_counts_json(sub), PERIOD_COLS, "left")
    else:
        rows = rows.join(_rows_per_period(sub, "sub_row_count"), PERIOD_COLS, "left")
        rows = rows.withColumn("form_counts_json", null.cast("string"))
    if num is None:
        rows = rows.withColumn("num_row_count", null.cast("bigint"))
    else:
        rows = rows.join(_rows_per_period(num, "num_row_count"), PERIOD_COLS, "left")

    if tables is None:
        has = {f"{t}_exists": F.col(f"{t}_row_count").isNotNull() for t in ("sub", "num")}
    else:
        flags = [F.bool_or(F.col("table") == t).alias(f"{t}_exists") for t in ("sub", "num")]
        rows = rows.join(tables.groupBy(*PERIOD_COLS).agg(*flags), PERIOD_COLS, "left")
        has = {f"{t}_exists": F.col(f"{t}_exists") for t in ("sub", "num")}
    rows = rows.withColumns(has)

    def if_there(c: str, *tables: str, needs: bool = True) -> Column:
        """A count is 0 if its tables exist without such rows, and missing if they or the
        columns that it needs do not exist."""
        there = F.lit(needs)
        for t in tables:
            there = there & F.col(f"{t}_exists")
        return F.when(there, F.coalesce(F.col(c), F.lit(0))).alias(c)

    has_company = sub is not None and "cik" in sub.columns
    has_filing = has_company and num is not None and "adsh" in sub.columns and "adsh" in num.columns

    def known_json(field: str, out: str) -> Column:
        pairs = F.transform("known", lambda k: F.struct(k["known"], k[field]))
        return F.to_json(F.map_from_entries(pairs)).alias(out)

    return rows.select(
        *PERIOD_COLS,
        period_key(*PERIOD_COLS).alias("quarter"),
        "sub_exists",
        "num_exists",
        if_there("sub_row_count", "sub"),
        if_there("num_row_count", "num"),
        if_there("distinct_cik_count_in_sub", "sub", needs=has_company),
        if_there("distinct_cik_count_in_num", "sub", "num", needs=has_filing),
        F.coalesce("form_counts_json", F.lit("{}")).alias("form_counts_json"),
        known_json("in_sub", "known_presence_in_sub_json"),
        known_json("in_num", "known_presence_in_num_json"),
        known_json("usable", "known_presence_usable_json"),
        known_json("classification", "known_classification_json"),
    )


def _rows_per_period(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*PERIOD_COLS).agg(_count_rows(name))


# What ends a line in Unicode text besides the line feed, and what is blank.
LINE_ENDS = ["\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def classify_lines(
    df: DataFrame,
    text: str,
    keys: list[str],
    categories: list[tuple[str, str, list[str] | None]],
    group: str | None = None,
) -> DataFrame:
    """Lines that match a category: keys, line number from 1, category, trimmed line.

    ``categories`` are (label, pattern, groups) in order; the first that matches
    wins, and only counts for rows whose ``group`` is in its list (None: all).
    """
    # byte searches and a one-letter split take half the time of one regex
    lined = F.col(text)
    for end in LINE_ENDS:
        lined = F.replace(lined, F.lit(end), F.lit("\n"))
    # the outer form: Catalyst would guard the plain one by splitting the text twice
    lines = df.select(
        *keys,
        *([group] if group and group not in keys else []),
        F.posexplode_outer(F.split(lined, "\n")).alias("at", "raw"),
    )
    hits = []
    for label, pattern, groups in categories:
        hit = F.col("raw").rlike(pattern)
        if groups is not None:
            hit = hit & F.col(group).isin(list(groups))
        hits.append(F.when(hit, F.lit(label)))
    snippet = F.regexp_replace("raw", f"^{BLANK}+|{BLANK}+$", "")
    found = lines.withColumn("category", F.coalesce(*hits)).where(F.col("category").isNotNull())
    # blank lines are never findings; trimming is left to the few lines that match
    found = found.where(snippet != "")
    number = (F.col("at") + 1).cast("int").alias("line")
    return found.select(*keys, number, "category", snippet.alias("snippet"))
