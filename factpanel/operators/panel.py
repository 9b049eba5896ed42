"""Time series per company: year over year, trailing four filings, steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from factpanel.functions.ids import period_label
from factpanel.functions.numeric import (
    finite_sql,
    nan_to_null,
    quoted,
    safe_ratio,
    sum_skipping_missing,
)
from factpanel.schema import DELTA_COLS, TTM_COLS, TTM_YOY_COLS, YOY_COLS

YEAR_ROWS = 4
# A change of a trailing sum looks back four rows, and that sum three more.
LOOK_BACK = 7
# Rows of a company that one task holds at once.
BLOCK_ROWS = 50_000
PLACE_COLS = ["_before", "_block", "_own", "_alone"]

Build = Callable[[DataFrame, WindowSpec], DataFrame]


def panel_order(df: DataFrame, by_period: bool = True) -> list[Column]:
    """Panel order, missing last; the filing id stands in for input order."""
    names = ["dataset_year", "dataset_quarter", "adsh"]
    if by_period:
        names = ["period", *names]
    there = set(df.columns)
    return [F.col(c).asc_nulls_last() for c in names if c in there]


def sort_panel(df: DataFrame) -> DataFrame:
    """Rows by company and panel order, for output. Windows carry their own order."""
    return df.orderBy(F.col("cik").asc_nulls_last(), *panel_order(df))


def place_in_companies(df: DataFrame, by_period: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Cut the rows of every company into blocks at exact row numbers, lazily.

    Adds ``_before`` (rows of the company before this one in panel order), ``_block``, and
    ``_own``: a row that the next block needs for looking back is there once more, with
    ``_own`` false. Counts per company and period, added up along the company, say how many
    rows come before a period; inside a period rows are numbered. So no task ever holds
    more of a company than one of its periods, or its list of periods.

    Call it on narrow rows, such as filings before their facts are joined.
    """
    names = ["period", "dataset_year", "dataset_quarter"] if by_period else ["dataset_year", "dataset_quarter"]
    group = ["cik", *[c for c in names if c in df.columns]]
    order = [F.col(c).asc_nulls_last() for c in group[1:]]
    counts = df.where(F.col("cik").isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("cik").orderBy(*(order or [F.lit(0)])).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    counts = counts.select(*[F.col(c).alias(f"_of_{c}") for c in group], "_offset")

    tie = F.expr(f"xxhash64({', '.join(quoted(c) for c in df.columns)})")
    inside = [F.col("adsh").asc_nulls_last()] if "adsh" in df.columns else []
    # rows without a company need no place: each gets a group of its own
    alone = F.when(F.col("cik").isNull(), tie)
    numbered = df.withColumn("_alone", alone).withColumn(
        "_row", F.row_number().over(Window.partitionBy(*group, "_alone").orderBy(*inside, tie)) - 1
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
    placed = numbered.join(counts, same, "left").withColumn("_before", F.col("_row") + F.coalesce("_offset", F.lit(0)))
    size = max(block_rows, LOOK_BACK + 1)
    block = F.floor(F.col("_before") / size)
    carried = F.col("cik").isNotNull() & (F.col("_before") % size >= size - LOOK_BACK)
    blocks = F.when(carried, F.array(block, block + 1)).otherwise(F.array(block))
    split = placed.withColumn("_block", F.explode(blocks))
    return split.withColumn("_own", F.col("_block") == block).select(*df.columns, *PLACE_COLS)


def over_companies(df: DataFrame, build: Build, by_period: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Apply window columns per company in panel order.

    One shuffle and one sort by company and block serve all columns. Rows that were not
    placed yet (see :func:`place_in_companies`) are placed here, which reads ``df`` twice.
    Rows without a company id have no earlier rows.
    """
    rows = df if set(PLACE_COLS) <= set(df.columns) else place_in_companies(df, by_period, block_rows)
    window = Window.partitionBy("cik", "_block", "_alone").orderBy("_before")
    return build(rows, window).where("_own").drop(*PLACE_COLS)


def _earlier(c: str, back: int) -> str:
    """Name of the helper column with the value ``back`` rows earlier."""
    return f"_{c}_{back}"


def _yoy(c: str) -> dict[str, Column]:
    return {f"{c}_yoy": safe_ratio(c, _earlier(c, YEAR_ROWS)) - 1}


def _ttm(c: str) -> dict[str, Column]:
    """Without a company there is no sum, so the row's own value is left out as well."""
    parts = [finite_sql(_earlier(c, back)) for back in range(YEAR_ROWS - 1, 0, -1)]
    own = finite_sql(f"CASE WHEN cik IS NOT NULL THEN {c} END")
    return {f"ttm_{c}": sum_skipping_missing([*parts, own])}


def _delta(c: str) -> dict[str, Column]:
    return {f"{c}_delta": nan_to_null(f"{c} - {_earlier(c, 1)}")}


def _with_series(
    df: DataFrame,
    window: WindowSpec,
    yoy: list[str] = (),
    ttm: list[str] = (),
    delta: list[str] = (),
) -> DataFrame:
    """The asked series of the columns that exist.

    Every earlier value is looked up once, in one window step, and shared by the
    series that use it.
    """
    there = set(df.columns)
    yoy, ttm, delta = ([c for c in cols if c in there] for cols in (yoy, ttm, delta))
    looks = [(c, YEAR_ROWS) for c in yoy] + [(c, 1) for c in delta]
    looks += [(c, back) for c in ttm for back in range(1, YEAR_ROWS)]
    if not looks:
        return df
    # two equal rows without a company may share a window, and must not see each other
    known = F.col("cik").isNotNull()
    looked = {_earlier(c, back): F.when(known, F.lag(c, back).over(window)) for c, back in set(looks)}
    made: dict[str, Column] = {}
    for cols, series in ((yoy, _yoy), (ttm, _ttm), (delta, _delta)):
        for c in cols:
            made |= series(c)
    return df.withColumns(looked).withColumns(made).drop(*looked)


def _with_ttm_margin(df: DataFrame) -> DataFrame:
    if not {"ttm_net_income", "ttm_revenue"} <= set(df.columns):
        return df
    return df.withColumn("ttm_net_margin", safe_ratio("ttm_net_income", "ttm_revenue"))


def yoy_columns(cols: list[str] = YOY_COLS) -> Build:
    """``x_yoy``: x over x four rows earlier, minus one; no filling of gaps."""
    return lambda df, window: _with_series(df, window, yoy=cols)


def ttm_columns(cols: list[str] = TTM_COLS) -> Build:
    """``ttm_x``: sum over the last four rows, at least one present; the trailing margin."""
    return lambda df, window: _with_ttm_margin(_with_series(df, window, ttm=cols))


def delta_columns(cols: list[str] = DELTA_COLS) -> Build:
    """``x_delta``: x minus x one row earlier."""
    return lambda df, window: _with_series(df, window, delta=cols)


def ttm_yoy_columns() -> Build:
    """Trailing sums, and their change over four rows."""

    def build(df: DataFrame, window: WindowSpec) -> DataFrame:
        return _with_series(ttm_columns()(df, window), window, yoy=TTM_YOY_COLS)

    return build


def panel_columns() -> Build:
    """Everything: yearly changes, trailing sums with theirs, steps.

    Two window steps over the same shuffle and sort: one for all earlier values,
    one for the earlier trailing values.
    """

    def build(df: DataFrame, window: WindowSpec) -> DataFrame:
        first = _with_series(df, window, yoy=YOY_COLS, ttm=TTM_COLS, delta=DELTA_COLS)
        return _with_series(_with_ttm_margin(first), window, yoy=TTM_YOY_COLS)

    return build


def company_ttm(df: DataFrame, cik: int, column: str, check: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Trailing sum of one metric of one company, ordered by dataset period.

    ``check`` looks for the company first and raises if it has no row.
    """
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    rows = df.where(F.col("cik") == cik)
    if check and rows.isEmpty():
        raise ValueError(f"no rows of company {cik}")
    there = set(rows.columns)
    rows = rows.select("cik", "dataset_year", "dataset_quarter", "adsh", column, *[c for c in PLACE_COLS if c in there])
    done = over_companies(rows, ttm_columns([column]), False, block_rows)
    label = period_label("dataset_year", "dataset_quarter").alias("period")
    return done.orderBy(*panel_order(done, by_period=False)).select(label, f"ttm_{column}")


def _keep_first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """First row per key. Catalyst puts a group limit below the shuffle, so a hot
    key sends one row per task."""
    window = Window.partitionBy(key).orderBy(*order)
    first = df.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(window))
    return first.where("_n = 1").drop("_n")


def _last_in(df: DataFrame) -> list[Column]:
    names = ["dataset_year", "dataset_quarter", "adsh"]
    there = set(df.columns)
    return [F.col(c).desc_nulls_last() for c in names if c in there]


def latest_by_text(df: DataFrame) -> DataFrame:
    """Latest filing per company by (fy, fp, filed) as text.

    As text "FY" sorts before "Q1", and a missing value counts as latest.
    """
    order = [F.col(c).cast("string").desc_nulls_first() for c in ("fy", "fp", "filed")]
    return _keep_first(df, "cik", [*order, *_last_in(df)])


# Rank of the fiscal period within its year.
FISCAL_RANK = {"Q1": 1, "Q2": 2, "Q3": 3, "Q4": 4, "FY": 5}


def fiscal_rank(c: str = "fp") -> Column:
    rank = F.lit(0)
    for name, place in FISCAL_RANK.items():
        rank = F.when(F.col(c) == name, F.lit(place)).otherwise(rank)
    return rank


def latest_by_rank(df: DataFrame) -> DataFrame:
    """Latest filing per company by fiscal year and rank of the fiscal period."""
    order = [F.col("fy").desc_nulls_first(), fiscal_rank().desc()]
    return _keep_first(df, "cik", [*order, *_last_in(df)])


def first_by_name(df: DataFrame, by: str = "revenue") -> DataFrame:
    """Row with the highest value per company name."""
    order = [F.col(by).desc_nulls_last(), *panel_order(df, by_period=False)]
    return _keep_first(df, "name", order)
