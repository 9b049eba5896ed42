import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factpanel.operators import compare, panel, profile
from factpanel.plans.fundamentals import enrich_panel
from factpanel.schema import DELTA_COLS, TTM_COLS, YOY_COLS

METRICS = sorted(set(YOY_COLS) | set(TTM_COLS) | set(DELTA_COLS))


@pytest.fixture(scope="module")
def frame():
    """A panel with gaps, zeros, a hot company, ties in period and null company ids."""
    rng = np.random.default_rng(5)
    n = 400
    cik = rng.integers(1, 25, n).astype(object)
    cik[rng.random(n) < 0.35] = 7
    cik[rng.random(n) < 0.05] = None
    df = pd.DataFrame({"adsh": [f"f{i:04d}" for i in range(n)], "cik": cik})
    df["period"] = rng.integers(20200101, 20200140, n)
    df["dataset_year"] = 2020
    df["dataset_quarter"] = rng.integers(1, 5, n)
    for m in METRICS:
        v = rng.integers(-40, 40, n) / 8.0
        v[rng.random(n) < 0.15] = np.nan
        df[m] = v
    return df


def to_spark(spark, df):
    numbers = ", ".join(f"{m} double" for m in METRICS)
    schema = f"adsh string, cik bigint, period bigint, dataset_year int, dataset_quarter int, {numbers}"
    rows = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r)
        for r in df.astype(object).itertuples(index=False)
    ]
    rows = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in rows]
    return spark.createDataFrame(rows, schema).repartition(5)


def expected(df):
    """The definitions, in pandas, with infinities kept and NaN as missing."""
    df = df.sort_values(["cik", "period", "dataset_year", "dataset_quarter", "adsh"]).copy()
    g = df.groupby("cik")
    for c in YOY_COLS:
        df[f"{c}_yoy"] = g[c].transform(lambda s: s / s.shift(4) - 1)
    for c in TTM_COLS:
        df[f"ttm_{c}"] = g[c].transform(lambda s: s.rolling(4, min_periods=1).sum())
    df["ttm_net_margin"] = df["ttm_net_income"] / df["ttm_revenue"]
    g = df.groupby("cik")
    for c in panel.TTM_YOY_COLS:
        df[f"{c}_yoy"] = g[c].transform(lambda s: s / s.shift(4) - 1)
    for c in DELTA_COLS:
        df[f"{c}_delta"] = g[c].transform(lambda s: s - s.shift(1))
    derived = [c for c in df.columns if c.endswith(("_yoy", "_delta")) or c.startswith("ttm_")]
    df.loc[df["cik"].isna(), derived] = np.nan
    return df.set_index("adsh").sort_index(), derived


@pytest.mark.parametrize("block_rows", [1_000_000, 40, 3])
def test_panel_columns(spark, frame, block_rows):
    """Same values whether a company is one block or many."""
    want, derived = expected(frame)
    rows = enrich_panel(to_spark(spark, frame), block_rows=block_rows).toPandas()
    got = rows.set_index("adsh").sort_index()
    assert list(got.index) == list(want.index)
    assert len(derived) == 23 + 5 + 1 + 4 + 16
    assert set(derived) <= set(got.columns)
    for c in derived:
        np.testing.assert_allclose(
            got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c
        )


def test_copies_of_one_filing(spark):
    """A company of identical rows only can be cut as well."""
    df = spark.range(50).select(
        F.lit("same").alias("adsh"), F.lit(1).cast("bigint").alias("cik"), F.lit(5).alias("period"),
        F.lit(2.0).alias("revenue"),
    )
    out = panel.over_companies(df, panel.ttm_columns(["revenue"]), block_rows=9)
    assert out.count() == 50
    counts = {r["ttm_revenue"]: r["count"] for r in out.groupBy("ttm_revenue").count().collect()}
    assert counts == {2.0: 1, 4.0: 1, 6.0: 1, 8.0: 47}


def test_one_shuffle_serves_all_columns(spark, frame):
    placed = panel.place_in_companies(to_spark(spark, frame))
    out = panel.over_companies(placed, panel.panel_columns())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sum("_block#" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 1


def test_no_job_before_the_action(spark, frame):
    df = to_spark(spark, frame)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "a plan")
    enrich_panel(df)
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_equal_rows_without_a_company_are_alone(spark):
    rows = [("a", None, 5, 10.0), ("a", None, 5, 10.0), ("b", 1, 5, 10.0)]
    df = spark.createDataFrame(rows, "adsh string, cik bigint, period int, revenue double")
    build = lambda d, w: panel.delta_columns(["revenue"])(panel.ttm_columns(["revenue"])(d, w), w)
    out = panel.over_companies(df, build).where("cik IS NULL").collect()
    assert [(r["ttm_revenue"], r["revenue_delta"]) for r in out] == [(None, None)] * 2


def test_a_hot_company_is_spread(spark):
    df = spark.range(0, 30_000, 1, 4).select(
        F.col("id").cast("string").alias("adsh"), F.lit(1).cast("bigint").alias("cik"),
        (F.col("id") % 300).alias("period"), F.lit(1.0).alias("revenue"),
    )
    placed = panel.place_in_companies(df, block_rows=1000)
    assert placed.groupBy("_block").count().agg(F.max("count")).first()[0] <= 1000 + panel.LOOK_BACK
    out = panel.over_companies(placed, panel.ttm_columns(["revenue"]))
    assert out.count() == 30_000 and out.where("ttm_revenue = 4").count() == 29_997


def test_sort_panel(spark, frame):
    got = [r["adsh"] for r in panel.sort_panel(to_spark(spark, frame)).select("adsh").collect()]
    order = ["cik", "period", "dataset_year", "dataset_quarter", "adsh"]
    assert got == list(frame.sort_values(order)["adsh"])


def test_infinite_values_are_missing_in_sums(spark):
    rows = [("a", 1, 1, float("inf")), ("b", 1, 2, 3.0), ("c", 1, 3, float("-inf"))]
    df = spark.createDataFrame(rows, "adsh string, cik int, period int, revenue double")
    out = panel.over_companies(df, panel.ttm_columns(["revenue"])).orderBy("adsh").collect()
    assert [r["ttm_revenue"] for r in out] == [None, 3.0, 3.0]


def test_order_without_period(spark):
    rows = [("b", 1, 2024, 1, 1.0), ("a", 1, 2024, 1, 2.0), ("c", 1, 2023, 4, 5.0)]
    cols = "adsh string, cik int, dataset_year int, dataset_quarter int, revenue double"
    df = spark.createDataFrame(rows, cols)
    out = panel.over_companies(df, panel.delta_columns(["revenue"])).orderBy("adsh").collect()
    assert [r["revenue_delta"] for r in out] == [-3.0, -1.0, None]


@pytest.mark.parametrize("block_rows", [100, 3])
def test_company_ttm(spark, block_rows):
    rows = [(f"a{q}", 1, 2020 + q // 4, q % 4 + 1, float(q)) for q in range(20)]
    cols = "adsh string, cik int, dataset_year int, dataset_quarter int, revenue double"
    df = spark.createDataFrame(rows, cols)
    out = panel.company_ttm(df, 1, "revenue", block_rows=block_rows).collect()
    assert [r["period"] for r in out][:2] == ["2020 Q1", "2020 Q2"]
    assert [r["ttm_revenue"] for r in out] == [float(sum(range(max(0, q - 3), q + 1))) for q in range(20)]
    with pytest.raises(ValueError):
        panel.company_ttm(df, 2, "revenue")
    with pytest.raises(ValueError):
        panel.company_ttm(df, 1, "nothing")


LATEST = "adsh string, cik int, fy string, fp string, filed string, revenue double, name string"


def test_two_meanings_of_latest(spark):
    rows = [
        ("a", 1, "2023", "Q1", "20230501", 1.0, "A"), ("b", 1, "2023", "FY", "20240201", 2.0, "A"),
        ("c", 2, "2023", "Q1", "20230501", 3.0, "B"), ("d", 2, None, "Q1", "20230501", 4.0, "B"),
        ("e", None, "2023", "Q1", "20230501", 5.0, "C"), ("f", 3, "2023", "H1", "1", 6.0, "D"),
        ("g", 3, "2023", None, "1", 7.0, "D"),
    ]
    df = spark.createDataFrame(rows, LATEST)
    ids = lambda d: {r["cik"]: r["adsh"] for r in d.collect()}
    assert ids(panel.latest_by_text(df)) == {1: "a", 2: "d", 3: "g"}
    assert ids(panel.latest_by_rank(df)) == {1: "b", 2: "d", 3: "g"}
    plan = panel.latest_by_text(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit"):]


def test_first_by_name(spark):
    rows = [("a", 1, "x", "y", "z", None, "A"), ("b", 1, "x", "y", "z", 2.0, "A"), ("c", 1, "x", "y", "z", 1.0, "A")]
    out = panel.first_by_name(spark.createDataFrame(rows, LATEST)).collect()
    assert [r["adsh"] for r in out] == ["b"]


def test_compare(spark):
    rows = [
        ("a", 1, "2023", "Q4", "x", 1.0, "A"), ("b", 1, "2023", "FY", "x", 2.0, "A"),
        ("c", 2, "2023", "Q1", "x", 3.0, "B"),
    ]
    df = spark.createDataFrame(rows, LATEST)
    out = compare.compare_companies(df, 1, 2, ["nothing", "revenue"])
    assert out.columns == ["Metric", "CIK 1", "CIK 2"]
    assert [tuple(r) for r in out.collect()] == [("nothing", None, None), ("revenue", 2.0, 3.0)]
    with pytest.raises(ValueError):
        compare.compare_companies(df, 1, 9)


def test_bridge(spark):
    cols = "name string, revenue double, net_income double, gross_margin double, operating_margin double"
    rows = [
        ("all", 100.0, 10.0, 0.5, 0.25), ("no_gross", 100.0, 10.0, None, 0.25),
        ("no_op", 100.0, 10.0, 0.5, None), ("none", 100.0, 10.0, None, None), ("inf", 0.0, 1.0, float("inf"), None),
    ]
    out = compare.profit_bridge(spark.createDataFrame(rows, cols), ["name"])
    got = {}
    for r in out.orderBy("name", "position").collect():
        got.setdefault(r["name"], []).append((r["step"], r["value"]))
    assert got["all"] == [("Revenue", 100.0), ("Gross Profit", -50.0), ("Operating Income", -25.0), ("Net Income", -15.0)]
    assert got["no_gross"] == [("Revenue", 100.0), ("Operating Income", -75.0), ("Net Income", -15.0)]
    assert got["no_op"] == [("Revenue", 100.0), ("Gross Profit", -50.0), ("Net Income", -40.0)]
    assert got["none"] == [("Revenue", 100.0), ("Net Income", -90.0)]
    assert got["inf"] == [("Revenue", 0.0), ("Gross Profit", None), ("Net Income", None)]


def test_profile(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 301) / 4, "b": rng.normal(size=301), "t": rng.choice(list("xyz"), 301)})
    pdf.loc[:10, "b"] = np.nan
    pdf["e"] = np.nan
    pdf["h"] = 7.0
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, t string, e double, h double").repartition(3)
    got = {r["column"]: r for r in profile.profile_columns(df).collect()}
    want = pdf.describe(include="all")
    for c in ("a", "b", "h"):
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
            assert got[c][mine] == pytest.approx(want[c][theirs], abs=1e-9), (c, mine)
        assert got[c]["count"] == want[c]["count"]
    assert (got["t"]["count"], got["t"]["unique"], got["t"]["freq"]) == (301, 3, want["t"]["freq"])
    assert got["t"]["top"] == pdf["t"].value_counts().index[0]
    assert got["e"]["count"] == 0 and got["e"]["p50"] is None
    rough = {r["column"]: r for r in profile.profile_columns(df, approximate=True).collect()}
    assert rough["h"]["p50"] == 7.0
    assert profile.profile_columns(df, max_columns=2).count() == 2


def test_histogram(spark):
    rows = [(0.0, 0.0), (30.0, 3.0), (30.0, 3.0), (15.0, 1.5), (None, 1.0), (float("inf"), 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = {(r["x_bin"], r["y_bin"]): r["n"] for r in profile.histogram_2d(df, "x", "y").collect()}
    assert got == {(1, 1): 1, (30, 30): 2, (16, 16): 1}
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert {(r["x_bin"], r["y_bin"]) for r in profile.histogram_2d(flat, "x", "y", 4).collect()} == {(1, 1), (1, 4)}


def test_histogram_computes_its_input_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    df = spark.range(500).selectExpr("id * 1D AS x", "id % 7 * 1D AS y").mapInPandas(seen, "x double, y double")
    assert sum(r["n"] for r in profile.histogram_2d(df, "x", "y").collect()) == 500
    assert calls.value == 500


ODD_NUMBERS = {
    # a narrow range far from zero: few relative bins
    "ids": [10**9 + 7 * i for i in range(4000)],
    # one far value in the bin of many close ones
    "cluster": [1e15 + i for i in range(2000)] + [1e15 + 2e12] * 3,
    "signs": [-5.0, -5.0, -1e-300, 0.0, -0.0, 5e-324, 1e308, 3.0, 2.0],
    "infinite": [float("inf"), float("inf"), 1.0, 2.0, -3.0, 4.0],
    "repeated": [2.5] * 1000 + [2.5000001],
    "one": [42.0],
}


@pytest.mark.parametrize("name", ODD_NUMBERS)
@pytest.mark.parametrize("parts", [4, 1 << 16])
def test_quartiles_of_odd_columns(spark, monkeypatch, name, parts):
    monkeypatch.setattr(profile, "PARTS", parts)
    values = [float(v) for v in ODD_NUMBERS[name]]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(3)
    got = profile.profile_columns(df).first()
    want = pd.Series(values).describe()
    assert (got["min"], got["max"]) == (min(values), max(values))
    for mine, p in profile.QUARTILES.items():
        place = (len(values) - 1) * p
        low, high = sorted(values)[math.floor(place)], sorted(values)[math.ceil(place)]
        assert got[mine] == (low if low == high else pytest.approx(low + (high - low) * (place % 1), rel=1e-15)), mine
    assert got["count"] == len(values)
    if math.isfinite(sum(values)) and len(values) > 1 and name != "signs":
        assert got["std"] == pytest.approx(want["std"], rel=1e-9)
        assert got["mean"] == pytest.approx(want["mean"])
    elif len(values) == 1:
        assert got["std"] is None


def test_no_task_sorts_a_bin(spark):
    """A million ids in a narrow range lie in few bins; what is sorted in the end is small."""
    ids = spark.range(1_000_000).selectExpr("'a' AS column", "id * 3 + 1e9 AS number", "1L AS n")
    rows = ids.withColumn("_bin", profile._bin_of(ids["number"]))
    assert rows.select("_bin").distinct().count() < 4
    bins = rows.groupBy("column", "_bin").agg(F.sum("n").alias("n"), F.min("number").alias("_from"), F.max("number").alias("_to"))
    bins = bins.withColumns({"_start": profile._before(["column"], "_bin"), "count": F.lit(1_000_000)})
    held = bins.where(profile._wanted()).select("column", "_bin", "count", "_start", "_from", "_to")
    last, sizes = profile._held(rows, held)
    assert last.groupBy(*sizes).count().agg(F.max("count")).first()[0] <= 16
    got = profile._picked(rows, held).first()
    assert (got["p25_low"], got["p50_low"], got["p75_high"]) == (1e9 + 3 * 249_999, 1e9 + 3 * 499_999, 1e9 + 3 * 750_000)
