"""Which months were processed: a small append-only table per job."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

Month = tuple[int, int]
LANDED = "landed"
SCREENED = "screened"


def _path(root: str, job: str) -> str:
    return f"{root}/_state/{job}"


def last_month(spark: SparkSession, root: str, job: str = LANDED) -> Month | None:
    """Latest month the job has recorded, or None."""
    try:
        done = spark.read.schema("year int, month int").parquet(_path(root, job))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    top = done.agg(F.max(F.struct("year", "month")).alias("m")).first()["m"]
    return None if top is None else (top["year"], top["month"])


def record_month(spark: SparkSession, root: str, month: Month, job: str = LANDED) -> None:
    row = spark.createDataFrame([month], "year int, month int")
    row.coalesce(1).write.mode("append").parquet(_path(root, job))


def following(month: Month) -> Month:
    year, number = month
    return (year + 1, 1) if number == 12 else (year, number + 1)
