"""Arithmetic under one rule for missing values.

NaN never leaves a helper: it becomes null, so that ``NaN >= 5`` (true in Spark)
cannot let a row through a filter. A non-zero number over zero is an infinity and
zero over zero is null, whatever the ANSI setting of the session.

Arguments are SQL expressions as text, a column name being the usual one. A panel
has some hundred derived columns, and one parsed text each is far cheaper to build
than a tree of column objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")
NULL_SQL = "CAST(NULL AS DOUBLE)"
INF_SQL = "CAST('Infinity' AS DOUBLE)"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literals(texts: list[str]) -> str:
    """Comma-separated SQL literals of the texts."""
    escaped = [t.replace("\\", "\\\\").replace("'", "\\'") for t in texts]
    return ", ".join(f"'{t}'" for t in escaped)


def nan_to_null_sql(x: str) -> str:
    return f"nanvl({x}, {NULL_SQL})"


def nan_to_null(x: str) -> Column:
    return F.expr(nan_to_null_sql(x))


def finite_sql(x: str) -> str:
    return f"CASE WHEN NOT (isnan({x}) OR abs({x}) = {INF_SQL}) THEN {x} END"


def finite(x: str) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.expr(finite_sql(x))


def ratio_sql(a: str, b: str) -> str:
    # the power of a zero is an infinity with the sign of that zero
    by_zero = f"CASE WHEN {b} = 0 THEN {a} * power({b}, -1D) END"
    return nan_to_null_sql(f"coalesce(try_divide({a}, {b}), {by_zero})")


def safe_ratio(a: str, b: str) -> Column:
    return F.expr(ratio_sql(a, b))


def to_double(x: str) -> Column:
    """Strict cast: under ANSI a text that is no number raises."""
    return nan_to_null(f"CAST({x} AS DOUBLE)")


def lenient_double(x: str) -> Column:
    """Number, or null where the text is none.

    Java also reads a trailing type letter (``5d``, ``1.5f``) as a number; such
    text counts as not numeric here.
    """
    text = f"CAST({x} AS STRING)"
    plain = f"CASE WHEN NOT ({text} RLIKE '[0-9.][dDfF]\\\\s*$') THEN try_cast({text} AS DOUBLE) END"
    return nan_to_null(plain)


def lenient_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Lenient numeric cast of the listed columns that exist (one projection)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    made = {}
    for c in cols:
        if c not in types:
            continue
        is_number = isinstance(types[c], T.NumericType)
        made[c] = to_double(quoted(c)) if is_number else lenient_double(quoted(c))
    return df.withColumns(made) if made else df


def sum_skipping_missing(parts: list[str]) -> Column:
    """Sum of the parts that are present; null if none is.

    The order of the additions is fixed by the list, so the result does not
    depend on how rows were distributed.
    """
    total = "0D"
    for p in parts:
        total = f"({total} + coalesce({p}, 0D))"
    return F.expr(f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {total} END")
