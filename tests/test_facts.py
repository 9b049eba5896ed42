import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from factpanel.operators import facts, merge, screens, unions
from factpanel.plans.fundamentals import fundamentals_of_companies
from factpanel.plans.screening import simple_screener
from factpanel.schema import DEFAULT_TAGS, RATIOS, SCREENER_TAGS

SUB = "adsh string, cik string, name string, form string, fy string, fp string, period string, filed string, dataset_year int, dataset_quarter int"
NUM = "adsh string, tag string, value string, dataset_year int, dataset_quarter int"


def header(adsh, cik="1", form="10-K", quarter=1):
    return (adsh, cik, "Co" + str(cik), form, "2024", "Q1", "20240331", "20240501", 2024, quarter)


def test_tags_are_whole():
    assert list(DEFAULT_TAGS) == [
        "revenue", "net_income", "gross_profit", "operating_income", "eps_basic", "eps_diluted",
        "total_assets", "total_liabilities", "total_equity", "cfo", "cfi", "cff",
    ]
    assert sum(len(t) for t in DEFAULT_TAGS.values()) == 26
    assert {m: t[0] for m, t in DEFAULT_TAGS.items() if m in SCREENER_TAGS} == SCREENER_TAGS
    assert DEFAULT_TAGS["revenue"] == ["Revenues", "SalesRevenueNet", "RevenueFromContractWithCustomerExcludingAssessedTax"]
    assert DEFAULT_TAGS["net_income"] == ["NetIncomeLoss", "ProfitLoss"]
    assert DEFAULT_TAGS["gross_profit"] == ["GrossProfit", "GrossProfitLoss"]
    assert DEFAULT_TAGS["total_assets"] == ["Assets", "AssetsTotal"]
    assert DEFAULT_TAGS["total_liabilities"] == ["Liabilities", "LiabilitiesTotal"]
    for metric, word in (("cfo", "Operating"), ("cfi", "Investing"), ("cff", "Financing")):
        name = f"NetCashProvidedByUsedIn{word}Activities"
        assert DEFAULT_TAGS[metric] == [name, f"{name}ContinuingOperations"]


def test_ratios_are_whole():
    """Numerator and denominator, as the rows of a filing define them."""
    assert RATIOS == {
        "gross_margin": ("gross_profit", "revenue"), "operating_margin": ("operating_income", "revenue"),
        "net_margin": ("net_income", "revenue"), "roa": ("net_income", "total_assets"),
        "roe": ("net_income", "total_equity"), "asset_turnover": ("revenue", "total_assets"),
        "debt_to_equity": ("total_liabilities", "total_equity"), "debt_to_assets": ("total_liabilities", "total_assets"),
        "equity_ratio": ("total_equity", "total_assets"), "assets_to_equity": ("total_assets", "total_equity"),
    }


def test_facts_of_one_company_are_cut_before_the_pivot(spark):
    sub = spark.createDataFrame([header("a"), header("b", cik="2")], SUB)
    num = spark.createDataFrame([("a", "Revenues", "1", 2024, 1), ("b", "Revenues", "2", 2024, 1)], NUM)
    rows = fundamentals_of_companies(sub.withColumn("cik", F.col("cik").cast("bigint")), num, [2])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    assert [(r["adsh"], r["revenue"]) for r in rows.collect()] == [("b", 2.0)]


def test_fundamentals(spark):
    sub = spark.createDataFrame(
        [header("a"), header("b", form="10-K/A"), header("c"), header(None), header("a", quarter=2)], SUB
    )
    num = spark.createDataFrame(
        [
            ("a", "Revenues", "100", 2024, 1), ("a", "SalesRevenueNet", "120", 2024, 1),
            ("a", "NetIncomeLoss", "-12", 2024, 1), ("a", "Assets", "0", 2024, 1),
            ("a", "NetCashProvidedByUsedInOperatingActivities", "30", 2024, 1),
            ("a", "NetCashProvidedByUsedInInvestingActivities", "-6", 2024, 1),
            ("a", "Other", "999", 2024, 1), ("a", "Revenues", None, 2024, 1),
            ("b", "Revenues", "5", 2024, 1), (None, "Revenues", "7", 2024, 1),
        ],
        NUM,
    )
    rows = facts.build_fundamentals(facts.scan_typed(sub), num).collect()
    assert len(rows) == 4  # the amendment falls out, everything else stays
    by = {(r["adsh"], r["dataset_quarter"]): r for r in rows}
    a = by["a", 1]
    assert (a["cik"], a["period"]) == (1, 20240331)
    assert (a["revenue"], a["net_income"], a["net_margin"]) == (120.0, -12.0, -0.1)
    assert a["roa"] == float("-inf")
    assert (a["cfo"], a["fcf_approx"], a["fcf_to_net_income"]) == (30.0, 24.0, -2.0)
    assert a["gross_margin"] is None
    # no facts, a null filing id, and the same id in another period
    for key in (("c", 1), (None, 1), ("a", 2)):
        assert by[key]["revenue"] is None


def test_tags_with_quotes(spark):
    num = spark.createDataFrame([("a", "it's \\ odd", "2", 2024, 1), ("a", "its", "9", 2024, 1)], NUM)
    assert facts.tag_pivot(num, {"m": ["it's \\ odd"]}).first()["m"] == 2.0


def test_strict_and_lenient_values(spark, conf):
    conf(spark__sql__ansi__enabled="true")
    sub = spark.createDataFrame([header("a")], SUB)
    num = spark.createDataFrame([("a", "Revenues", "x", 2024, 1), ("a", "Revenues", "3", 2024, 1)], NUM)
    with pytest.raises(PySparkException):
        facts.build_fundamentals(sub, num).collect()
    assert facts.build_fundamentals(sub, num, strict=False).first()["revenue"] == 3.0


def test_semi_join(spark):
    sub = spark.createDataFrame([header("a"), header("a"), header(None)], SUB)
    num = spark.createDataFrame(
        [("a", "t", "1", 2024, 1), ("a", "t", "1", 2024, 1), ("b", "t", "1", 2024, 1), (None, "t", "1", 2024, 1)], NUM
    )
    assert facts.facts_of_filings(num, sub).count() == 2


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_filing_is_split_by_aqe(spark, conf):
    """A third of all header rows share one filing id: the join splits that key."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    n = 30_000
    sub = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("adsh"),
        F.lit("10-K").alias("form"), F.col("id").alias("cik"),
        F.lit(2024).alias("dataset_year"), F.lit(1).alias("dataset_quarter"),
    )
    num = sub.where("cik < 100").select(
        "adsh", F.lit("Revenues").alias("tag"), F.col("cik").cast("double").alias("value"),
        "dataset_year", "dataset_quarter",
    )
    df = facts.build_fundamentals(sub, num)
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert df.count() == n
    assert df.where("adsh = 'hot' and revenue = 99").count() == n // 3

    keep = facts.facts_of_filings(sub, sub.where("cik < 100"))
    assert "SortMergeJoin(skew=true)" in final_plan(keep)
    assert keep.count() == n // 3 + 66


def test_pivot_plan(spark, conf, tmp_path):
    """Tag filter reaches the scan, only needed columns are read, facts are combined
    before their shuffle."""
    conf(spark__sql__maxMetadataStringLength="10000")
    rows = [("a", "Revenues", 1.0, "x", 2024, 1)]
    cols = "adsh string, tag string, value double, footnote string, dataset_year int, dataset_quarter int"
    path = str(tmp_path / "num")
    spark.createDataFrame(rows, cols).write.partitionBy("dataset_year", "dataset_quarter").parquet(path)
    narrow = {"revenue": ["Revenues"], "net_income": ["NetIncomeLoss"]}
    plan = facts.tag_pivot(spark.read.parquet(path), narrow)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "footnote" not in scan
    pushed = scan[scan.index("PushedFilters"):]
    assert "IsNotNull(adsh)" in pushed and "In(tag" in pushed
    assert plan.count("Exchange") == 1 and plan.index("partial_max") > plan.index("Exchange")


def merged(rows, cols):
    return sorted(tuple(r[c] for c in cols) for r in rows.collect())


@pytest.mark.parametrize("slice_rows", [100_000, 2, 1])
def test_fan_out(spark, slice_rows):
    """Facts multiply within a filing, however its longest list is cut."""
    sub = spark.createDataFrame([header("a"), header("b"), header("c"), header("d", form="8-K")], SUB)
    num = spark.createDataFrame(
        [
            ("a", "R", "10", 2024, 1), ("a", "R", "20", 2024, 1), ("a", "R", None, 2024, 1),
            ("a", "N", "1", 2024, 1), ("a", "N", "2", 2024, 1),
            ("b", "N", "5", 2024, 1), ("d", "R", "1", 2024, 1), ("a", "X", "1", 2024, 1),
        ],
        NUM,
    )
    tags = {"revenue": "R", "net_income": "N"}
    out = merge.merge_metrics(sub, num, tags=tags, slice_rows=slice_rows)
    got = [(r["adsh"], r["revenue"], r["net_income"], r["net_margin"]) for r in out.collect()]
    want = [("a", r, n, None if r is None else n / r) for r in (10.0, 20.0, None) for n in (1.0, 2.0)]
    want += [("b", None, 5.0, None), ("c", None, None, None)]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_hot_filing_fans_out_over_tasks(spark):
    """One filing with 3 x 100 facts: its million rows come out of several tasks."""
    period = (F.lit(2024).alias("dataset_year"), F.lit(1).alias("dataset_quarter"))
    sub = spark.range(0, 40).select(
        F.col("id").cast("string").alias("adsh"), F.col("id").alias("cik"), F.lit("10-K").alias("form"), *period
    )
    tags = {"revenue": "R", "net_income": "N", "gross_profit": "G"}
    hot = [spark.range(100).select(F.lit("7").alias("adsh"), F.lit(t).alias("tag"), F.col("id").cast("double").alias("value"), *period) for t in tags.values()]
    num = hot[0].unionByName(hot[1]).unionByName(hot[2])
    out = merge.merge_metrics(sub, num, tags=tags)
    by_task = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in by_task) == 1_000_000 + 39
    assert sum(r["count"] >= 100_000 for r in by_task) >= 2
    assert out.where("adsh = '7'").select("revenue", "net_income", "gross_profit").distinct().count() == 1_000_000


def test_collapse_and_thresholds(spark):
    sub = spark.createDataFrame([header("a"), header("b")], SUB)
    num = spark.createDataFrame(
        [("a", "R", "10", 2024, 1), ("a", "R", "20", 2024, 1), ("b", "R", "5", 2024, 1), ("a", "N", "4", 2024, 1)], NUM
    )
    tags = {"revenue": "R", "net_income": "N"}
    out = simple_screener(sub, num, min_revenue=1, tags=tags, collapse="max")
    assert merged(out, ["adsh", "revenue"]) == [("a", 20.0), ("b", 5.0)]
    assert simple_screener(sub, num, min_net_margin=0.3, tags=tags).count() == 1
    assert simple_screener(sub, num, tags=tags, max_rows=1).count() == 1
    assert simple_screener(sub, num, tags=tags, max_rows=0).count() == 3
    with pytest.raises(ValueError):
        simple_screener(sub, num, tags=tags, collapse="min")


PANEL = "adsh string, cik int, revenue double, gross_margin double, roe double, fcf_approx double, debt_to_equity double, fy int, fp string, filed string"


def test_all_ranks_come_from_one_scan(spark, tmp_path):
    columns = [f"m{i}" for i in range(24)]
    spark.range(200).selectExpr("id AS adsh", *[f"(id * {i + 7}) % 101 * 1D AS {c}" for i, c in enumerate(columns)]).write.parquet(str(tmp_path / "p"))
    ranked = screens.rank_all(spark.read.parquet(str(tmp_path / "p")), columns, 5)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    # the limit of a group works before the shuffle too
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")
    assert ranked.count() == 24 * 2 * 5


def test_tasks_keep_only_leading_rows(spark):
    """Few rows of a task get as far as the sort, also where most values are equal; the ranks
    are those of a whole sort."""
    rng = random.Random(7)
    odd = [0.0, -0.0, 1.0, float("inf"), float("-inf"), float("nan"), None]
    rows = [
        (rng.choice([None, "ü", "Z", "a", f"f{i}", f"f{i}", f"f{i}"]), i, rng.choice([None, 2023, 2024]), rng.choice(odd), float(i % 2), rng.random(), None)
        for i in range(6000)
    ]
    metrics = ["odd", "even", "any", "none"]
    df = spark.createDataFrame(rows, "adsh string, cik int, dataset_year int, odd double, even double, any double, none double").repartition(2)
    plain = lambda x: None if x is None or x != x else x
    last = lambda x: (x is None, x.encode() if isinstance(x, str) else x)
    kept = screens.leading_rows(df.select("adsh", "dataset_year", "even", "any"), ["even", "any"], 7, ["adsh", "dataset_year"])
    assert 14 <= kept.count() <= 2 * 2 * 2 * 7
    found = {(r["metric"], r["direction"], r["rank"]): (r["value"], r["adsh"]) for r in screens.rank_all(df, metrics, 7).collect()}
    for i, metric in enumerate(metrics, 3):
        for sign, direction in ((-1, "high"), (1, "low")):
            own = sorted((r for r in rows if plain(r[i]) is not None), key=lambda r: (sign * r[i], last(r[0]), last(r[2])))[:7]
            assert [found.pop((metric, direction, n), None) for n in range(1, len(own) + 1)] == [(r[i], r[0]) for r in own]
    assert not found


def test_screens(spark):
    rows = [
        ("a", 1, 6e7, 0.2, 0.3, 1.0, 1.0, 2024, "Q1", "1"),
        ("b", 1, 6e7, 0.2, 0.5, 1.0, 1.0, 2024, "FY", "1"),   # "FY" < "Q1" as text: not the latest
        ("c", 2, 6e7, 0.2, 0.3, 1.0, 3.0, 2024, "Q1", "1"),   # too much debt
        ("d", 3, None, 0.2, 0.3, 1.0, 1.0, 2024, "Q1", "1"),
        ("e", 4, -1.0, 0.2, float("nan"), 1.0, 1.0, 2024, "Q1", "1"),
        ("f", 5, 7e7, 0.2, float("inf"), 1.0, 1.0, 2024, "Q1", "1"),
    ]
    df = spark.createDataFrame(rows, PANEL)
    names = lambda d: [r["adsh"] for r in d.collect()]
    assert names(screens.value_screen(df)) == ["f", "b", "a", "c"]
    assert names(screens.value_screen_latest(df)) == ["f", "a"]
    assert names(screens.revenue_screen(df)) == ["f", "a", "b", "c"]
    assert names(screens.revenue_screen(df.drop("revenue"))) == []
    assert names(screens.rank_by(df, "roe", 3)) == ["f", "b", "a"]
    assert names(screens.rank_by(df, "revenue", 1, ascending=True)) == ["e"]
    ranked = screens.rank_all(df, ["roe", "revenue"], 3)
    for metric in ("roe", "revenue"):
        for direction in ("high", "low"):
            own = ranked.where((F.col("metric") == metric) & (F.col("direction") == direction)).orderBy("rank")
            single = screens.rank_by(df, metric, 3, ascending=direction == "low")
            assert [(r["adsh"], r["value"]) for r in own.collect()] == [(r["adsh"], r[metric]) for r in single.collect()]
    with pytest.raises(ValueError):
        screens.rank_all(df, ["roe", "nothing"])
    assert names(screens.top_revenue(df, 10))[-1] == "d"
    with pytest.raises(ValueError):
        screens.rank_by(df, "nothing")
    assert screens.sheet_subset(df, 2).columns == ["cik", "fy", "fp", "revenue", "gross_margin", "roe", "fcf_approx"]
    assert screens.companies_with_filings(df, 2).collect() == [(1, 2)]
    assert names(screens.company_rows(df, cik=2)) == ["c"]


def test_union_by_name(spark, conf):
    conf(spark__sql__ansi__enabled="true")
    a = spark.createDataFrame([(1, 2, "x")], "id int, n int, only_a string")
    b = spark.createDataFrame([(3, "text", 1.5)], "id bigint, n string, only_b double")
    out = unions.union_by_name(a, b)
    assert out.columns == ["id", "n", "only_a", "only_b"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "2", "x", None), (3, "text", None, 1.5)]


def test_union_distinct_treats_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, t string")
    assert unions.union_distinct(a, a).count() == 2


def test_months_to_quarters(spark):
    rows = [(2024, 1, "a"), (2024, 3, "a"), (2024, 4, "a"), (2024, 12, "b")]
    df = spark.createDataFrame(rows, "year int, month int, x string")
    out = unions.months_to_quarters(df)
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2024, 1), ("a", 2024, 2), ("b", 2024, 4)]


@pytest.mark.parametrize(("slice_rows", "block_facts"), [(100_000, 3), (5, 10_000), (7, 2)])
def test_fan_out_in_blocks(spark, slice_rows, block_facts):
    """One filing with most facts of a tag, many of them equal, nulls, -0.0 and NaN among them; a tag
    that two metrics share."""
    sub = spark.createDataFrame([header("a"), header("b"), header("c"), header("e")], SUB)
    values = ["1", "2", None, "-0.0", "0.0", "NaN", "7", "7", "7", "7", "7", "7", "7", "8"]
    num = spark.createDataFrame(
        [("a", "R", v, 2024, 1) for v in values]
        + [("a", "N", v, 2024, 1) for v in ("1", "1", "2", "3")]
        + [("b", "N", "5", 2024, 1), ("b", "R", "6", 2024, 1), ("e", "R", "4", 2024, 1), ("e", "R", "4", 2024, 1)],
        NUM,
    )
    tags = {"revenue": "R", "net_income": "N", "again": "N"}
    out = merge.fan_out_facts(sub, num, tags, slice_rows=slice_rows, block_facts=block_facts)
    plain = merge.fan_out_facts(sub, num, tags)
    assert out.columns == plain.columns

    def shown(df):
        return sorted(tuple(str(r[c]) for c in ("adsh", *tags)) for r in df.collect())

    got = shown(out)
    assert got == shown(plain) and len(got) == 14 * 4 * 4 + 1 + 1 + 2
    assert sum(r[1] == "-0.0" for r in got) == 16 == sum(r[1] == "0.0" for r in got)


def test_a_third_of_all_facts_under_one_tag(spark):
    """The lists of a filing with 60,000 facts of one tag, half of them equal, stay bounded, and its
    rows come out of several tasks."""
    period = (F.lit(2024).alias("dataset_year"), F.lit(1).alias("dataset_quarter"))
    hot = spark.range(60_000).select(
        F.lit("hot").alias("adsh"), F.lit("R").alias("tag"),
        F.when(F.col("id") % 2 == 0, "5").otherwise(F.col("id").cast("string")).alias("value"), *period,
    )
    rest = spark.range(2_000).select(F.concat(F.lit("f"), "id").alias("adsh"), F.lit("R").alias("tag"), F.lit("1").alias("value"), *period)
    sub = spark.createDataFrame([header("hot"), *[header(f"f{i}") for i in range(2_000)]], SUB)
    out = merge.fan_out_facts(sub, hot.unionByName(rest), {"revenue": "R", "net_income": "N"}, block_facts=500)
    assert out.count() == 62_000
    told = out.where("adsh = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(told) == 4 and max(r["count"] for r in told) < 2 * 60_000 / 4
    assert out.where("adsh = 'hot' AND revenue = 5").count() == 30_001
