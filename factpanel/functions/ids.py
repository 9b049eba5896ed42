"""Company ids, period keys, months and quarters."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Period = tuple[int, int]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_id(c: Column | str, width: int = 10) -> Column:
    """First digit run of the text, zero-filled to ``width``; longer ids stay whole.

    A trailing ``.0`` is cut first. Null, and text without a digit, give null.
    """
    text = F.regexp_replace(_col(c).cast("string"), r"\.0$", "")
    digits = F.regexp_extract(text, r"([0-9]+)", 1)
    return (
        F.when(F.length(digits) >= width, digits)
        .when(F.length(digits) > 0, F.lpad(digits, width, "0"))
    )


def period_key(year: Column | str, quarter: Column | str) -> Column:
    """``2024_3``"""
    return F.concat_ws("_", _col(year).cast("string"), _col(quarter).cast("string"))


def period_label(year: Column | str, quarter: Column | str) -> Column:
    """``2024 Q3``"""
    return F.concat(_col(year).cast("string"), F.lit(" Q"), _col(quarter).cast("string"))


def parse_period_key(c: Column | str) -> tuple[Column, Column]:
    """Year and quarter of a ``2024_3`` text; null for anything else (months too)."""
    pattern = r"^([0-9]{4})_([1-4])$"
    year = F.regexp_extract(_col(c), pattern, 1).try_cast("int")
    return year, F.regexp_extract(_col(c), pattern, 2).try_cast("int")


def as_period(period: Period | str) -> Period:
    """A (year, quarter) tuple from either spelling of a period."""
    if isinstance(period, str):
        found = re.fullmatch(r"(\d{4})_([1-4])", period)
        if not found:
            raise ValueError(f"not a period: {period!r}")
        return int(found.group(1)), int(found.group(2))
    year, quarter = period
    return int(year), int(quarter)


def period_str(period: Period | str) -> str:
    return "{}_{}".format(*as_period(period))


def quarter_of_month(month: Column | str) -> Column:
    return F.floor((_col(month) + 2) / 3).cast("int")


def next_month(year: Column | str, month: Column | str) -> tuple[Column, Column]:
    first = F.add_months(F.make_date(_col(year), _col(month), F.lit(1)), 1)
    return F.year(first), F.month(first)


def month_before(day: Column | str) -> tuple[Column, Column]:
    """Month before the given date: the candidate when nothing was processed yet."""
    earlier = F.add_months(F.trunc(_col(day), "month"), -1)
    return F.year(earlier), F.month(earlier)
