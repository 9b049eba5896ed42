"""Places of rows in an order, and blocks of bounded size, without one task for a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factpanel.llm.common import stored


def in_ranges(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """df dealt over tasks by ranges of keys and order, with the number of the range in
    `part`, and stored, so that a repeated task finds the same ranges. Rows that are equal in
    all these columns share a range; a key with many rows covers several."""
    return stored(df.repartitionByRange(*keys, *order).withColumn("part", F.spark_partition_id()), name)


def _with_earlier(ranged: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """ranged with `before`: the weight of the rows of equal keys in the ranges before."""
    weights = ranged.groupBy(*keys, "part").agg(F.sum(weight).alias("weight"))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    weights = weights.select(
        *[F.col(k).alias(f"key_{k}") for k in keys],
        F.col("part").alias("key_part"), F.coalesce(F.sum("weight").over(earlier), F.lit(0)).alias("before"),
    )
    same: Column = F.col("part") == F.col("key_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"key_{k}"))
    return ranged.join(weights, same).select(*ranged.columns, "before")


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """df with `place`: 0, 1, ... in the given order among the rows of equal keys (null is a
    key too, and comes first in an order).

    Rows are numbered inside their range; the counts of the ranges before it are added.
    """
    ranged = in_ranges(df, keys, order, name)
    inside = Window.partitionBy(*keys, "part").orderBy(*order)
    own = ranged.withColumn("place", F.row_number().over(inside) - 1)
    return _with_earlier(own, keys, F.lit(1)).withColumn("place", F.col("place") + F.col("before")).select(*df.columns, "place")


def in_blocks(df: DataFrame, keys: list[str], order: list[str], weight: str, most: int, name: str) -> DataFrame:
    """df with `block`, a struct: rows of equal keys, in the given order, cut where their
    weights reach a multiple of `most`, so that a block weighs less than `most` and one row,
    on any number of ranges."""
    ranged = in_ranges(df, keys, order, name)
    so_far = Window.partitionBy(*keys, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("so_far", F.coalesce(F.sum(weight).over(so_far), F.lit(0)))
    number = F.floor((F.col("so_far") + F.col("before")) / F.lit(most)).cast("long")
    placed = _with_earlier(own, keys, F.col(weight))
    return placed.withColumn("block", F.struct(*keys, number.alias("number"))).select(*df.columns, "block")
