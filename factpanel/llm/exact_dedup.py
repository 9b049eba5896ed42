"""Exact duplicates with a split of heavy hitters.

A Misra-Gries summary of the digests finds all texts that could hold more than a
fixed share of the rows. Those few are counted exactly, and their winners are
broadcast, so that the copies of the largest groups are settled where they lie. All
other groups are small, and meet in an ordinary shuffle by digest.

Defined cases
- A null text counts as empty. Texts are equal if they are identical after A-Z became
  a-z; other letters keep their case.
- Of a group the row with the largest doc_id stays; a null doc_id is smaller than any
  other. Of rows that are equal in both, exactly one stays.
- Other columns take no part and may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factpanel.llm.common import free_name, lower_ascii, stored

COUNTERS = 1024
FAN_IN = 64


def _merge(batches: Iterator[tuple[pa.Array, pa.Array]], k: int) -> dict[str, int]:
    """Misra-Gries over weighted digests, a batch at a time: counts are added, then all
    fall by the (k+1)-th largest, so that at most k remain."""
    held: dict[str, int] = {}
    for digests, counts in batches:
        for d, c in zip(digests.to_pylist(), counts.to_pylist(), strict=True):
            held[d] = held.get(d, 0) + c
        if len(held) > k:
            cut = sorted(held.values(), reverse=True)[k]
            held = {d: c - cut for d, c in held.items() if c > cut}
    return held


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest): a superset of the digests that hold more than 1 / (counters + 1) of the
    rows, with at most `counters` rows. Partitions are summarised where they lie, and
    summaries are merged as a tree."""
    made = "digest string, seen long, part int"

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def counted():
            for batch in batches:
                values = pc.value_counts(batch.column(0))
                yield values.field("values"), values.field("counts")

        held = _merge(counted(), counters)
        part = [TaskContext.get().partitionId()] * len(held)
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64()), pa.array(part, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["digest", "seen", "part"])

    def merge(table):
        held = _merge(iter([(table.column("digest"), table.column("seen"))]), counters)
        part = table.column("part")[0].as_py() // FAN_IN
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64()), pa.array([part] * len(held), pa.int32())]
        return pa.table(columns, names=["digest", "seen", "part"])

    summary = stored(digests.select("digest").mapInArrow(summarise, made), "summaries")
    last = summary.agg(F.max("part")).first()[0] or 0
    while last:
        groups = summary.groupBy(F.floor(F.col("part") / FAN_IN).alias("node"))
        summary = stored(groups.applyInArrow(merge, made), "summaries")
        last //= FAN_IN
    return summary.select("digest")


def duplicate_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id (the doc_id that stays), group_size, kept and
    text_sha256 (of the normalised text)."""
    keys = stored(
        docs.select(
            "doc_id",
            F.sha2(lower_ascii(F.col("text")), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    winner = F.max(F.struct("doc_id", "row")).alias("winner")
    candidates = frequent_digests(keys, counters)
    heavy = stored(
        keys.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(winner, F.count(F.lit(1)).alias("group_size")),
        "heavy",
    )
    # at most `counters` rows, so both sides may be broadcast
    hot = keys.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    rest = keys.join(F.broadcast(heavy), "digest", "left_anti").withColumns(
        {"winner": F.max(F.struct("doc_id", "row")).over(group), "group_size": F.count(F.lit(1)).over(group)}
    )
    return hot.unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns.

    Copies of the heavy texts go before any shuffle. What is left of those texts (rows
    with the winning doc_id) is cut to one row each with a partial step in every task;
    all other documents cross the network once, by digest.
    """
    digest, order = free_name(docs, "digest"), free_name(docs, "place")
    named = docs.withColumn(digest, F.sha2(lower_ascii(F.col("text")), 256))
    keys = named.select("doc_id", F.col(digest).alias("digest"))
    candidates = frequent_digests(keys, counters)
    heavy = stored(
        keys.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))
        .where("size > 1"),
        "heavy",
    )
    winners = F.broadcast(heavy.select(F.col("digest").alias(digest), F.col("winner").alias(order)))
    hot = named.join(winners, digest).where(F.col("doc_id").eqNullSafe(F.col(order)))
    hot = hot.dropDuplicates([digest]).select(*docs.columns)
    latest = Window.partitionBy(digest).orderBy(F.col("doc_id").desc_nulls_last())
    rest = named.join(winners, digest, "left_anti").withColumn(order, F.row_number().over(latest))
    return hot.unionByName(rest.where(F.col(order) == 1).select(*docs.columns))
