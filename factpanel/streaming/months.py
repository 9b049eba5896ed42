"""New month releases, landed and rolled up as their files arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from factpanel.plans.state import record_month
from factpanel.plans.updates import REQUIRED_TABLES, month_complete, quarter_complete, quarter_of, roll_up_months
from factpanel.sources.landing import MONTH_FOLDER, land_tables

# Schema of Spark's binaryFile source.
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def new_month_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """Stream of the month files below a raw root: year, month, path.

    Only names are streamed; the content column is pruned, and each touched month
    is then read with its own header.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.tsv")
        .option("recursiveFileLookup", "true")
        .load(raw_root)
    )
    found = [F.regexp_extract("path", MONTH_FOLDER, i).try_cast("int") for i in (1, 2)]
    rows = files.select(found[0].alias("year"), found[1].alias("month"), "path")
    return rows.where(F.col("year").isNotNull())


def land_new_months(
    spark: SparkSession, raw_root: str, root: str, checkpoint: str, multi_line: bool | None = None
) -> StreamingQuery:
    """Process every month file that is new since the last run, then stop.

    The checkpoint stands in for a stored last month. A batch lands the touched
    months, rebuilds their quarters from all landed months and raises if a month or
    quarter is incomplete; the checkpoint then does not move, and the next run
    takes the same files again. Every step replaces whole partitions, so a batch
    that runs twice leaves the same tables.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        # one row per touched month
        months = sorted(tuple(r) for r in batch.select("year", "month").distinct().collect())
        if not months:
            return
        land_tables(spark, raw_root, root, months=True, only=months, multi_line=multi_line)
        for month in months:
            if not month_complete(spark, root, month):
                raise ValueError(f"month {month} is incomplete")
        for quarter in roll_up_months(spark, root, months):
            if not quarter_complete(spark, root, quarter):
                raise ValueError(f"quarter {quarter} is incomplete")
        for month in months:
            record_month(spark, root, month)

    return (
        new_month_files(spark, raw_root)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _tables_seen(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The tables of a month so far, and whether they are all that it needs."""
    seen = set(state.get[0].split(",")) if state.exists else set()
    for batch in batches:
        seen |= set(batch["table"])
    state.update((",".join(sorted(seen)),))
    yield pd.DataFrame([(*key, ",".join(sorted(seen)), set(REQUIRED_TABLES) <= seen)], columns=["year", "month", "tables", "complete"])


def months_seen(files: DataFrame) -> DataFrame:
    """(year, month, tables, complete) of every month that a batch of files (year, month, path)
    touches. What was seen of a month is keyed state: one short row for each month."""
    named = files.select("year", "month", F.regexp_extract("path", r"/([^/]+)\.tsv$", 1).alias("table"))
    return named.groupBy("year", "month").applyInPandasWithState(
        _tables_seen, "year int, month int, tables string, complete boolean", "tables string", "update", GroupStateTimeout.NoTimeout
    )


def advance_complete_months(
    spark: SparkSession, raw_root: str, root: str, checkpoint: str, multi_line: bool | None = None
) -> StreamingQuery:
    """Process what is new since the last run, month by month, then stop.

    A month is landed and rolled up as soon as all its tables have come, over any number of
    runs. A month that waits for a table holds back no other month, and is no failure. Files
    that come again for a month that is complete land it anew. What was seen is in
    the checkpoint; every step replaces whole partitions, so a batch that
    runs twice leaves the same tables.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        # one row per touched month
        months = sorted((r["year"], r["month"]) for r in batch.where("complete").collect())
        if not months:
            return
        land_tables(spark, raw_root, root, months=True, only=months, multi_line=multi_line)
        landed = [m for m in months if month_complete(spark, root, m)]
        roll_up_months(spark, root, landed)
        for month in landed:
            if not quarter_complete(spark, root, quarter_of(month)):
                raise ValueError(f"quarter {quarter_of(month)} is incomplete")
            record_month(spark, root, month)

    return (
        months_seen(new_month_files(spark, raw_root))
        .writeStream.outputMode("update")
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
