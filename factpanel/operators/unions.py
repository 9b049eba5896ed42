"""Stacking frames by column name, and rolling months up into quarters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factpanel.functions.ids import quarter_of_month


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack by name: missing columns are null, types are widened.

    Spark widens number types by itself. Where a column is text in one frame and
    not in another, both become text (under ANSI a plain union would read the
    text as a number and fail on other text).
    """
    kinds: dict[str, set] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(type(f.dataType))
    as_text = [c for c, k in kinds.items() if T.StringType in k and len(k) > 1]

    def texted(df: DataFrame) -> DataFrame:
        made = {c: F.col(c).cast("string") for c in as_text if c in df.columns}
        return df.withColumns(made) if made else df

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [texted(f) for f in frames]
    )


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Stack by name and keep one of identical rows (null equals null).

    Copies are dropped on the map side first, so a row that makes up a third of
    the input sends one copy per task.
    """
    return union_by_name(*frames).dropDuplicates()


def months_to_quarters(rows: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Rows of month releases as rows of quarters, identical ones kept once."""
    quarters = rows.withColumns(
        {
            "dataset_year": F.col(year).cast("int"),
            "dataset_quarter": quarter_of_month(month),
        }
    )
    return quarters.drop(year, month).dropDuplicates()
