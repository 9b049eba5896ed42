"""Simple screener table: filings joined to every fact of one tag per metric."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factpanel.functions.numeric import lenient_double, safe_ratio, to_double
from factpanel.operators.facts import (
    attach_facts,
    filings_not_in,
    filter_forms,
    join_per_filing,
    tag_pivot,
    with_known_keys,
)
from factpanel.schema import RATIOS, SCREENER_COLS, SCREENER_TAGS, filing_keys

#: About how many rows of one filing's product a task writes in a row.
SLICE_ROWS = 100_000
#: About how many facts of one tag of a filing are held together.
BLOCK_FACTS = 10_000


def fan_out_facts(
    filings: DataFrame,
    num: DataFrame,
    tags: dict[str, str],
    strict: bool = True,
    slice_rows: int = SLICE_ROWS,
    block_facts: int = BLOCK_FACTS,
) -> DataFrame:
    """Left join per tag, all facts kept: a filing with several facts of a tag is
    multiplied, and the counts of the tags multiply with each other.

    Facts are counted per filing and tag on the map side first. A filing with few facts, whose
    product is small, carries a short list per tag. The facts of any other filing are dealt
    to blocks by their value, and the blocks of its tags are joined part by part, a part
    being one block of each tag; so no task ever holds all facts of a filing and tag.
    """
    keys = filing_keys(filings, num)
    value = to_double("value") if strict else lenient_double("value")
    facts = (
        with_known_keys(num, keys)
        .where(F.col("tag").isin(sorted(set(tags.values()))))
        .select(*keys, "tag", value.alias("value"))
    )
    counts = facts.groupBy(*keys).agg(*[F.count_if(F.col("tag") == t).alias(m) for m, t in tags.items()])
    product = reduce(lambda a, b: a * b, [F.greatest(F.col(m), F.lit(1)).cast("double") for m in tags])
    most = F.greatest(*map(F.col, tags), F.lit(0))
    large = counts.withColumn("_product", product).where((F.col("_product") > slice_rows) | (most > block_facts))
    named = large.select(*keys)
    # a struct per fact, as collect_list would drop null values
    fact = F.struct(F.col("value"))
    lists = (
        facts.join(named, keys, "left_anti")
        .groupBy(*keys)
        .agg(*[F.collect_list(F.when(F.col("tag") == t, fact)).alias(m) for m, t in tags.items()])
    )
    few = join_per_filing(filings_not_in(filings, named, keys), lists, keys)
    for m in tags:
        few = few.withColumn(m, F.explode_outer(m))
    few = few.withColumns({m: F.col(m)["value"] for m in tags})
    return few.unionByName(_by_parts(filings, facts, large, keys, tags, slice_rows, block_facts))


def _by_parts(
    filings: DataFrame, facts: DataFrame, large: DataFrame, keys: list[str], tags: dict[str, str], slice_rows: int, block_facts: int
) -> DataFrame:
    """The product of the facts of large filings, one part of their blocks at a time."""
    longest, free = F.greatest(*map(F.col, tags), F.lit(0)), F.lit(True)
    blocks = {}
    for m in tags:  # the first of the longest is cut as often as the product asks for
        is_longest = free & (F.col(m) == F.col("_longest"))
        wanted = F.least(F.ceil(F.col("_product") / slice_rows).cast("long"), F.col(m))
        least = F.greatest(F.ceil(F.col(m) / block_facts), F.lit(1).cast("long"))
        blocks[f"_blocks_{m}"] = F.when(is_longest, F.greatest(wanted, least)).otherwise(least)
        free = free & ~is_longest
    sizes = large.withColumn("_longest", longest).withColumns(blocks)
    sizes = sizes.withColumn("_parts", reduce(lambda a, b: a * b, [F.col(b) for b in blocks]))
    sizes = sizes.withColumnsRenamed({m: f"_count_{m}" for m in tags}).drop("_longest", "_product")

    # equal facts are one row with their number, in rows of at most block_facts of them
    text = F.col("value").cast("string").alias("_text")
    same = facts.groupBy(*keys, "tag", text).agg(F.first("value").alias("value"), F.count(F.lit(1)).alias("_copies"))
    same = same.join(sizes, keys)
    same = same.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_copies - 1) DIV {block_facts})")))
    same = same.withColumn("_copies", F.least(F.lit(block_facts).cast("long"), F.col("_copies") - F.col("_chunk") * block_facts))
    dealt, stride = [], F.lit(1).cast("long")
    for m, t in tags.items():
        n, block = F.col(f"_blocks_{m}"), F.lit(m)
        dealt.append(F.when(F.col("tag") == t, F.struct(block.alias("metric"), n.alias("n"), stride.alias("stride"))))
        stride = stride * n
    of = F.explode(F.filter(F.array(*dealt), lambda x: x.isNotNull())).alias("of")
    pieces = same.select(*keys, "value", "_text", "_chunk", "_copies", "_parts", of).select("*", "of.*")
    pieces = pieces.withColumn("own", F.expr("pmod(xxhash64(_text, _chunk), n)"))
    # a block of one tag meets every combination of the blocks of the others
    pieces = pieces.withColumn("other", F.explode(F.expr("sequence(0L, _parts DIV n - 1)")))
    pieces = pieces.withColumn("_part", F.expr("(other DIV stride) * stride * n + own * stride + other % stride"))
    fact = F.struct("value", F.col("_copies").alias("copies"))
    # a list holds one block
    held = pieces.groupBy(*keys, "_part").agg(
        *[F.collect_list(F.when(F.col("metric") == m, fact)).alias(m) for m in tags]
    )
    rows = filings.join(sizes, keys).withColumn("_part", F.explode(F.expr("sequence(0L, _parts - 1)")))
    rows = rows.join(held, [*keys, "_part"], "left")
    # the number is given, as the rows are small here and would be put together again, and the
    # hash is one that the join does not have, or the step would be left out for it
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, F.xxhash64(*keys, "_part"))
    for m in tags:
        # of a tag that has facts a block may be empty, and then the part has no rows
        there = (F.col(f"_count_{m}") == 0) | (F.coalesce(F.size(m), F.lit(0)) > 0)
        rows = rows.where(there).withColumn(m, F.explode_outer(m))
    for m in tags:
        copies = F.greatest(F.coalesce(F.col(m)["copies"], F.lit(1)), F.lit(1))
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    rows = rows.withColumns({m: F.col(m)["value"] for m in tags})
    return rows.select(*filings.columns, *tags)


def merge_metrics(
    sub: DataFrame,
    num: DataFrame,
    forms: list[str] | None = None,
    tags: dict[str, str] | None = None,
    collapse: str | None = None,
    strict: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Screener table with the three margins that its metrics allow.

    By default every fact is a row of its own (see :func:`fan_out_facts`);
    ``collapse="max"`` gives one row per filing.
    """
    tags = tags or SCREENER_TAGS
    filings = filter_forms(sub, forms)
    if collapse is None:
        rows = fan_out_facts(filings, num, tags, strict, slice_rows)
    elif collapse == "max":
        rows = attach_facts(filings, tag_pivot(num, {m: [t] for m, t in tags.items()}, strict))
    else:
        raise ValueError(f"unknown collapse {collapse!r}")
    margins = ["gross_margin", "operating_margin", "net_margin"]
    made = {m: safe_ratio(*RATIOS[m]) for m in margins if set(RATIOS[m]) <= set(tags)}
    there = set(rows.columns)
    cols = [c for c in SCREENER_COLS if c in there]
    return rows.select(*cols, *tags).withColumns(made) if made else rows.select(*cols, *tags)
