"""The driver tables seen as filings and facts.

A filing is one supplier in one ship quarter, a fact is one line item, and a tag
is a part type with a line status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factpanel.schema import SCREENER_TAGS

TAGS: dict[str, list[str]] = {
    "revenue": ["STANDARD_O", "STANDARD_F", "PROMO_O"],
    "net_income": ["PROMO_F"],
    "gross_profit": ["SMALL_O", "SMALL_F"],
    "operating_income": ["LARGE_O"],
    "eps_basic": ["LARGE_F"],
    "eps_diluted": ["ECONOMY_F"],
    "total_assets": ["STANDARD_O", "ECONOMY_O"],
    "total_liabilities": ["MEDIUM_O"],
    "total_equity": ["MEDIUM_F", "SMALL_O"],
    "cfo": ["ECONOMY_O"],
    "cfi": ["PROMO_O"],
    "cff": ["LARGE_F", "MEDIUM_O"],
}

# One tag per metric, for the screener that keeps every fact: brands, of which a filing
# has about one fact each, so that all nine can be multiplied.
MERGE_TAGS = {metric: f"Brand#{n}" for n, metric in enumerate(SCREENER_TAGS, 1)}

FLOOR = 50_000.0


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _period(day: str) -> dict[str, Column]:
    return {
        "dataset_year": F.year(day).cast("int"),
        "dataset_quarter": F.quarter(day).cast("int"),
    }


def _filing_id() -> Column:
    parts = ["l_suppkey", "dataset_year", "dataset_quarter"]
    return F.concat_ws("-", *[F.col(c).cast("string") for c in parts])


def _day(c: Column) -> Column:
    return F.to_date(c).cast("string")


def _value() -> Column:
    price = F.col("l_extendedprice")
    return (
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
        .when(F.col("l_quantity") == 50, F.lit(0.0))
        .when(F.col("l_returnflag") == "R", -price)
        .otherwise(price)
    )


def num(spark: SparkSession, sf_dir: str, by_brand: bool = False) -> DataFrame:
    """Facts: one row per line item."""
    lines = read(spark, sf_dir, "lineitem").withColumns(_period("l_shipdate"))
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    tag = F.col("p_brand") if by_brand else F.concat_ws("_", "p_type", "l_linestatus")
    return rows.select(
        _filing_id().alias("adsh"),
        tag.alias("tag"),
        _value().alias("value"),
        _day(F.col("l_shipdate")).alias("ddate"),
        "dataset_year",
        "dataset_quarter",
    )


def sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing headers: one row per supplier and ship quarter."""
    lines = read(spark, sf_dir, "lineitem").withColumns(_period("l_shipdate"))
    made = lines.groupBy("l_suppkey", "dataset_year", "dataset_quarter").agg(
        F.max("l_shipdate").alias("last")
    )
    names = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    year, quarter = F.col("dataset_year"), F.col("dataset_quarter")
    form = (
        F.when((F.col("l_suppkey") + year + quarter) % 11 == 0, F.lit("8-K"))
        .when(quarter == 4, F.lit("10-K"))
        .otherwise(F.lit("10-Q"))
    )
    fiscal = F.when(quarter == 4, F.lit("FY")).otherwise(F.concat(F.lit("Q"), quarter.cast("string")))
    return made.join(names, F.col("l_suppkey") == F.col("s_suppkey")).select(
        _filing_id().alias("adsh"),
        F.col("l_suppkey").alias("cik"),
        F.col("s_name").alias("name"),
        form.alias("form"),
        year.alias("fy"),
        fiscal.alias("fp"),
        (year.cast("bigint") * 10000 + quarter * 300 + 30).alias("period"),
        _day(F.col("last")).alias("filed"),
        "dataset_year",
        "dataset_quarter",
    )


def _customer_filing() -> Column:
    parts = ["o_custkey", "dataset_year", "dataset_quarter"]
    return F.concat_ws("-", *[F.col(c).cast("string") for c in parts])


def customer_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing headers: one row per customer and order quarter. Some have no facts, as not
    every order has line items."""
    orders = read(spark, sf_dir, "orders").withColumns(_period("o_orderdate"))
    made = orders.groupBy("o_custkey", "dataset_year", "dataset_quarter").agg(F.max("o_orderdate").alias("last"))
    year, quarter = F.col("dataset_year"), F.col("dataset_quarter")
    return made.select(
        _customer_filing().alias("adsh"),
        F.col("o_custkey").alias("cik"),
        F.when(quarter == 4, "10-K").otherwise("10-Q").alias("form"),
        _day(F.col("last")).alias("filed"),
        year.alias("dataset_year"),
        quarter.alias("dataset_quarter"),
    )


def customer_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts: one row per line item of a customer's orders. Some filings have only facts
    without a value."""
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders").withColumns(_period("o_orderdate"))
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        _customer_filing().alias("adsh"),
        F.concat_ws("_", "p_type", "l_linestatus").alias("tag"),
        _value().alias("value"),
        "dataset_year",
        "dataset_quarter",
    )
