"""Report sinks, each a folder of part files, one per task, and the checkpoint of a frame."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text: CSV has no nested values."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    made = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, nested)}
    return df.withColumns(made) if made else df


def write_csv(df: DataFrame, path: str) -> None:
    _flat(df).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line; null fields are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed now and kept in the checkpoint folder of the session.

    What reads it more than once computes it once, also after the loss of an executor. The
    folder is the one that spark.checkpoint.dir names; a local session without it gets a
    temporary folder, any other has to name one that all executors share.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="factpanel-"))
    return df.checkpoint()
