"""Numbers as display text.

``format_number`` rounds the binary value half-even, the way printf-style
formatting in C does; ``format_string('%.2f')`` would round the shortest decimal
text half-up and differ on values such as 1.005.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factpanel.functions.numeric import INF


def _fixed(c: Column, digits: int) -> Column:
    """Fixed digits without thousands separators; infinities spelled inf."""
    plain = F.regexp_replace(F.format_number(c, digits), ",", "")
    return F.when(c == INF, F.lit("inf")).when(c == -INF, F.lit("-inf")).otherwise(plain)


def format_display(c: Column | str) -> Column:
    """Percent below 1, then plain with separators, millions (M), billions (B)."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    size = F.abs(c)
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
        .when(size < 1, F.concat(_fixed(c * 100, 2), F.lit("%")))
        .when(size >= 1e9, F.concat(_fixed(c / 1e9, 2), F.lit("B")))
        .when(size >= 1e6, F.concat(_fixed(c / 1e6, 2), F.lit("M")))
        .otherwise(F.format_number(c, 0))
    )


def format_short(c: Column | str) -> Column:
    """B, M and k with one decimal, smaller values with two."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    size = F.abs(c)
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
        .when(size >= 1e9, F.concat(_fixed(c / 1e9, 1), F.lit("B")))
        .when(size >= 1e6, F.concat(_fixed(c / 1e6, 1), F.lit("M")))
        .when(size >= 1e3, F.concat(_fixed(c / 1e3, 1), F.lit("k")))
        .otherwise(F.format_number(c, 2))
    )


def _numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def format_display_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """:func:`format_display` on the numeric ones of the columns; text passes through."""
    numeric = set(_numeric_names(df))
    made = {c: format_display(c) for c in cols if c in numeric}
    return df.withColumns(made) if made else df


def format_numeric_columns(df: DataFrame) -> DataFrame:
    """:func:`format_short` on every numeric column of the table."""
    made = {c: format_short(c) for c in _numeric_names(df)}
    return df.withColumns(made) if made else df
