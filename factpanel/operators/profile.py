"""Column profiles and two-dimensional histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factpanel.functions.numeric import finite, nan_to_null, quoted, to_double
from factpanel.sources.sinks import checkpointed

# Bins of values: steps to a doubling, the bin that the smallest exponents stay above, infinity.
STEPS, ZERO_BIN, INFINITE_BIN = 256, 300_000, 1_000_000
# Rounds that cut a range, and the parts of a range.
ROUNDS, PARTS = 2, 1 << 16
# The quartiles of a profile.
QUARTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
PROFILE_COLS = [
    "column", "count", "unique", "top", "freq",
    "mean", "std", "min", "p25", "p50", "p75", "max",
]


def profile_columns(
    df: DataFrame, max_columns: int | None = None, approximate: bool = False
) -> DataFrame:
    """One row per column, or for the first ``max_columns`` columns where that is given.

    Numbers get count, mean, deviation, extremes and quartiles with linear
    interpolation; other columns get count, distinct values and the most frequent
    value (the smallest one on ties). Quartiles are exact by default;
    ``approximate`` takes them from a bounded sketch.
    """
    fields = df.schema.fields[:max_columns]
    numeric = {f.name for f in fields if isinstance(f.dataType, T.NumericType)}
    cells = []
    for f in fields:
        number = to_double(quoted(f.name)) if f.name in numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if f.name in numeric else F.col(quoted(f.name)).cast("string")
        cells.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.name in numeric).alias("is_number"),
                number.alias("number"),
                text.alias("text"),
            )
        )
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    rows = _sketched(long) if approximate else _exact(long)
    types = {"column": "string", "top": "string"}
    types |= {c: "bigint" for c in ("count", "unique", "freq")}
    return rows.select(*[F.col(c).cast(types.get(c, "double")).alias(c) for c in PROFILE_COLS])


def _counted(long: DataFrame) -> DataFrame:
    """Rows per column and value: a frequent value becomes one row before the shuffle."""
    return long.groupBy("column", "is_number", "number", "text").agg(F.count(F.lit(1)).alias("n"))


def _texts(counted: DataFrame) -> DataFrame:
    """Distinct texts per column and the most frequent one, from counted rows.

    Apart from the numbers, as an aggregate with a text buffer sorts its input.
    """
    is_text = F.col("text").isNotNull()
    first = F.min(F.when(is_text, F.struct((-F.col("n")).alias("n"), "text")))
    return counted.where(~F.col("is_number")).groupBy("column").agg(
        F.count("text").alias("unique"),
        first["text"].alias("top"),
        (-first["n"]).alias("freq"),
    )


def _bin_of(number: Column) -> Column:
    """A number that grows with the value: 256 steps for each doubling, whatever the range
    of the column, so at most some hundred thousand in all."""
    size = F.floor(F.log2(F.abs(number)) * STEPS) + ZERO_BIN
    size = F.when(F.abs(number) == float("inf"), F.lit(INFINITE_BIN)).otherwise(size)
    bin_ = F.when(number == 0, F.lit(0)).when(number > 0, size).otherwise(-size).cast("long")
    return F.coalesce(bin_, F.lit(0))


def _middle_of(bin_: Column) -> Column:
    """A value inside the bin: sums of squares about it lose no digits."""
    size = F.pow(F.lit(2.0), (F.abs(bin_) - ZERO_BIN + 0.5) / STEPS)
    finite_bin = F.when(bin_ == 0, F.lit(0.0)).otherwise(F.signum(bin_.cast("double")) * size)
    return F.when(F.abs(bin_) == INFINITE_BIN, F.lit(0.0)).otherwise(finite_bin)


def _ranks() -> dict[str, Column]:
    """The two places, from 0, between which each quartile lies."""
    found = {}
    for name, p in QUARTILES.items():
        place = (F.col("count") - 1) * F.lit(p)
        found |= {f"{name}_low": F.floor(place), f"{name}_high": F.ceil(place)}
    return found


def _wanted() -> Column:
    """Whether the values from place `_start` on, `n` in number, hold a wanted place."""
    hits = [(F.col("_start") <= rank) & (rank < F.col("_start") + F.col("n")) for rank in _ranks().values()]
    return reduce(lambda a, b: a | b, hits)


def _before(keys: list[str], by: str) -> Column:
    window = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def _held(numbers: DataFrame, ranges: DataFrame) -> tuple[DataFrame, list[str]]:
    """The counted values of small ranges that hold the wanted places, and the key of a range.

    numbers: column, number, n, _bin; ranges: the bins with a wanted place, their first
    place `_start` and the ends `_from`, `_to` of the values in them. Each round cuts every
    range into PARTS of equal width between the ends of its own values, counts the values of
    each part, and goes on with the parts that hold a wanted place. A bin has at most 2^44
    different doubles and a round divides its width by 2^16, so after ROUNDS rounds a range
    has some thousand different values at most, however the column is distributed.
    """
    keys, carried = ["column", "_bin"], ["count", "_start", "_from", "_to"]
    rows = numbers
    for i in range(ROUNDS):
        rows = rows.join(ranges, keys)
        width = F.col("_to") - F.col("_from")
        part = F.floor((F.col("number") - F.col("_from")) / F.when(width > 0, width) * PARTS)
        rows = rows.withColumn(f"_part{i}", F.coalesce(F.least(part, F.lit(PARTS - 1)), F.lit(0)))
        parts = rows.groupBy(*keys, f"_part{i}", "count", "_start").agg(
            F.sum("n").alias("n"), F.min("number").alias("_from"), F.max("number").alias("_to")
        )
        parts = parts.withColumn("_start", F.col("_start") + _before(keys, f"_part{i}")).where(_wanted())
        keys = [*keys, f"_part{i}"]
        ranges, rows = parts.select(*keys, *carried), rows.drop(*carried)
    return rows.join(ranges, keys), keys


def _picked(numbers: DataFrame, ranges: DataFrame) -> DataFrame:
    """(column, p25_low, p25_high, ...): the values at the wanted places."""
    held, keys = _held(numbers, ranges)
    last = held.withColumn("_start", F.col("_start") + _before(keys, "number")).where(_wanted())
    inside = F.col("_start") + F.col("n")
    picks = [
        F.max(F.when((F.col("_start") <= rank) & (rank < inside), F.col("number"))).alias(name)
        for name, rank in _ranks().items()
    ]
    return last.groupBy("column").agg(*picks)


def _exact(long: DataFrame) -> DataFrame:
    """Everything from the counted values, which are made once and checkpointed.

    Counts per bin of values say which bins hold a quartile; those are cut into ever smaller
    ranges, so no task ever sorts a whole column or a whole bin.
    """
    counted = checkpointed(_counted(long)).withColumn("_bin", _bin_of(F.col("number")))
    present = F.col("number").isNotNull() | F.col("text").isNotNull()
    off = F.col("number") - _middle_of(F.col("_bin"))
    bins = counted.groupBy("column", "_bin").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("n"),
        F.sum(F.col("number") * F.col("n")).alias("_sum"),
        F.sum(off * F.col("n")).alias("_off"),
        F.sum(off * off * F.col("n")).alias("_squares"),
        F.min("number").alias("_from"),
        F.max("number").alias("_to"),
    )
    whole = Window.partitionBy("column")
    bins = bins.withColumns({"count": F.sum("n").over(whole), "_sum": F.sum("_sum").over(whole), "_start": _before(["column"], "_bin")})
    bins = bins.withColumn("mean", nan_to_null("try_divide(_sum, count)"))
    # sum of (x - mean)^2 of a bin, from the sums of (x - m) and (x - m)^2 about its middle m
    shift = _middle_of(F.col("_bin")) - F.col("mean")
    squares = F.col("_squares") + 2 * shift * F.col("_off") + F.col("n") * shift * shift
    total = bins.groupBy("column").agg(
        F.max("count").alias("count"), F.max("mean").alias("mean"), F.sum(squares).alias("_squares"),
        F.min("_from").alias("min"), F.max("_to").alias("max"),
    )
    held = bins.where(F.col("_from").isNotNull() & _wanted()).select("column", "_bin", "count", "_start", "_from", "_to")
    numbers = counted.where(F.col("number").isNotNull()).select("column", "_bin", "number", "n")
    rows = total.join(_picked(numbers, held), "column", "left")
    made = {"std": nan_to_null("sqrt(try_divide(if(_squares < 0, 0D, _squares), count - 1))")}
    for name, p in QUARTILES.items():
        place = (F.col("count") - 1) * F.lit(p)
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        part = low + (high - low) * (place - F.floor(place))
        made[name] = F.when(low == high, low).otherwise(F.nanvl(part, F.lit(None).cast("double")))
    return rows.withColumns(made).join(_texts(counted), "column", "left")


def _sketched(long: DataFrame) -> DataFrame:
    sketch = F.percentile_approx("number", list(QUARTILES.values()))
    rows = long.groupBy("column").agg(
        (F.count("number") + F.count("text")).alias("count"),
        F.avg("number").alias("mean"),
        nan_to_null("stddev_samp(number)").alias("std"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        sketch.alias("q"),
    )
    made = {name: F.col("q")[i] for i, name in enumerate(QUARTILES)}
    texts = _texts(_counted(long.where(~F.col("is_number"))))
    return rows.withColumns(made).join(texts, "column", "left")


def _bin(c: str, low: Column, high: Column, bins: int) -> Column:
    place = F.floor(F.try_divide((F.col(c) - low) * bins, high - low)) + 1
    return F.when(high > low, F.least(place, F.lit(bins))).otherwise(F.lit(1)).cast("int")


def histogram_2d(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """Rows per cell of an equal-width grid, cells from 1, the last one closed.

    Rows with a missing or infinite coordinate are left out. ``df`` is computed once: its
    two columns are checkpointed, and the bounds, a scalar subquery of one row, and the
    cells are made from those.
    """
    rows = checkpointed(df.select(finite(quoted(x)).alias("x"), finite(quoted(y)).alias("y")).dropna())
    ends = [f(c).alias(f"{name}_{c}") for c in "xy" for name, f in (("low", F.min), ("high", F.max))]
    bound = rows.agg(F.struct(*ends).alias("b")).scalar()
    cell = [
        _bin(c, bound.getField(f"low_{c}"), bound.getField(f"high_{c}"), bins).alias(f"{c}_bin")
        for c in "xy"
    ]
    return rows.select(*cell).groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))
