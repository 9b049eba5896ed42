import math

import pytest
from pyspark.errors import PySparkException

from factpanel.functions import ids
from factpanel.functions.display import format_display, format_display_columns, format_numeric_columns, format_short
from factpanel.functions.numeric import (
    lenient_columns,
    lenient_double,
    safe_ratio,
    sum_skipping_missing,
    to_double,
)

INF = float("inf")
NAN = float("nan")


def one(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_safe_ratio(spark, conf, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    cases = [
        (6.0, 3.0, 2.0), (1.0, 0.0, INF), (-1.0, 0.0, -INF), (0.0, 0.0, None),
        (None, 1.0, None), (1.0, None, None), (None, 0.0, None), (INF, INF, None), (1.0, INF, 0.0),
        (1.0, -0.0, -INF), (-1.0, -0.0, INF), (INF, 0.0, INF),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a double, b double")
    assert one(df.select(safe_ratio("a", "b"))) == [r for _, _, r in cases]


def test_lenient_double(spark):
    texts = ["1.5", " 7 ", "abc", "", None, "1e3", "5d", "1.5f", "inf", "-2", "NaN", "0x10"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = one(df.select(lenient_double("t")))
    assert got == [1.5, 7.0, None, None, None, 1000.0, None, None, INF, -2.0, None, None]


def test_strict_cast_raises(spark, conf):
    conf(spark__sql__ansi__enabled="true")
    df = spark.createDataFrame([("abc",)], "t string")
    with pytest.raises(PySparkException):
        df.select(to_double("t")).collect()


def test_lenient_columns_skip_absent(spark):
    df = spark.createDataFrame([("1", NAN, 3, "x")], "a string, b double, c int, d string")
    out = lenient_columns(df, ["a", "b", "c", "zzz"])
    assert out.columns == ["a", "b", "c", "d"]
    assert tuple(out.first()) == (1.0, None, 3.0, "x")


def test_sum_skipping_missing(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 2.0)], "a double, b double")
    assert one(df.select(sum_skipping_missing(["a", "b"]))) == [1.0, None, 3.0]


def python_display(v):
    """The definition, in plain Python."""
    if v is None or math.isnan(v):
        return None
    if -1 < v < 1:
        return f"{v * 100:.2f}%"
    for size, letter in ((1e9, "B"), (1e6, "M")):
        if abs(v) >= size:
            return f"{v / size:.2f}{letter}"
    return f"{v:,.0f}"


def python_short(v):
    if v is None or math.isnan(v):
        return None
    for size, letter in ((1e9, "B"), (1e6, "M"), (1e3, "k")):
        if abs(v) >= size:
            return f"{v / size:.1f}{letter}"
    return f"{v:,.2f}"


VALUES = [
    0.0, 0.5, -0.25, 0.00125, 0.0100005, 0.10005, 1.0, -1.0, 2.5, 3.5, 999.0, 1000.0, 1234.5, 12345.678,
    999999.4, 1e6, 1.005e6, 2.675e6, 1.25e6, 1e9, 1.005e9, 1234567890123.0, -5.5e9, 5e12, 1.125, 0.125, None, NAN,
    INF, -INF,
]


def test_display_rounds_like_printf(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v double").coalesce(1)
    assert one(df.select(format_display("v"))) == [python_display(v) for v in VALUES]
    assert one(df.select(format_short("v"))) == [python_short(v) for v in VALUES]


def test_format_columns(spark):
    df = spark.createDataFrame([("a", 1500, 2.0)], "t string, i int, d double")
    assert tuple(format_numeric_columns(df).first()) == ("a", "1.5k", "2.00")
    assert tuple(format_display_columns(df, ["t", "d"]).first()) == ("a", 1500, "2")


def test_normalize_id(spark):
    cases = {
        "320193": "0000320193", "320193.0": "0000320193", "CIK0000320193.0": "0000320193",
        "12345678901": "12345678901", "none": None, "": None, "12.5": "0000000012",
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string").coalesce(1)
    assert one(df.select(ids.normalize_id("t"))) == list(cases.values())
    null = spark.createDataFrame([(None,)], "t string")
    assert one(null.select(ids.normalize_id("t"))) == [None]


def test_periods(spark):
    assert ids.as_period("2024_3") == (2024, 3) == ids.as_period((2024, 3))
    assert ids.period_str((2024, 3)) == "2024_3"
    with pytest.raises(ValueError):
        ids.as_period("2024_03")
    df = spark.createDataFrame([("2024_3",), ("2024_03",), ("2024_5",), ("x",)], "k string").coalesce(1)
    got = [tuple(r) for r in df.select(*ids.parse_period_key("k")).collect()]
    assert got == [(2024, 3), (None, None), (None, None), (None, None)]


def test_months(spark):
    df = spark.createDataFrame([(2024, m) for m in range(1, 13)], "y int, m int").coalesce(1)
    assert one(df.select(ids.quarter_of_month("m"))) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    after = [tuple(r) for r in df.select(*ids.next_month("y", "m")).collect()]
    assert after == [(2024, m) for m in range(2, 13)] + [(2025, 1)]
    day = spark.sql("select date '2024-01-31' d union all select date '2024-03-31'").coalesce(1)
    assert [tuple(r) for r in day.select(*ids.month_before("d")).collect()] == [(2023, 12), (2024, 2)]
