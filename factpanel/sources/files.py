"""What files there are, and whether they can be read."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_SCHEMA = "path string, bytes bigint"


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Path and size of the files below a folder. Their content is not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select("path", F.col("length").alias("bytes"))


def _part(pattern: str, group: int, kind: str = "int") -> Column:
    text = F.regexp_extract("path", pattern, group)
    return F.when(text != "", text).try_cast(kind)


def tables_by_period(files: DataFrame) -> DataFrame:
    """Period, table and size from file paths, for both layouts of a landed root.

    Either ``<root>/<table>/dataset_year=Y/dataset_quarter=Q/...`` or one folder
    per period, ``<root>/Y_Q/parquet/<table>.parquet``. Other files, months among
    them, are left out.
    """
    parted = r"/([A-Za-z0-9]+)/dataset_year=([0-9]{4})/dataset_quarter=([1-4])/"
    folder = r"/([0-9]{4})_([1-4])/parquet/([A-Za-z0-9]+)\.parquet(?:/|$)"
    rows = files.select(
        F.coalesce(_part(parted, 2), _part(folder, 1)).alias("dataset_year"),
        F.coalesce(_part(parted, 3), _part(folder, 2)).alias("dataset_quarter"),
        F.coalesce(_part(parted, 1, "string"), _part(folder, 3, "string")).alias("table"),
        "bytes",
    )
    rows = rows.where(F.col("dataset_year").isNotNull())
    return rows.groupBy("dataset_year", "dataset_quarter", "table").agg(
        F.sum("bytes").alias("bytes")
    )


def _open(path: str):
    """Open a path the way executors see it (local disk, HDFS or an object store)."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parsed.path))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _spread(files: DataFrame) -> DataFrame:
    """The paths over as many tasks as a shuffle has. The number is given, as paths are
    short and would be put together in one task again."""
    spark = files.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.select("path").repartition(tasks, "path")


def _reader(first_rows: int | None):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            bad = []
            for path in batch["path"]:
                try:
                    with _open(path) as source:
                        rows = pq.ParquetFile(source).iter_batches(batch_size=first_rows or 65536)
                        for _ in rows:
                            if first_rows:
                                break
                except Exception as error:  # any failure is the finding
                    bad.append((path, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(bad, columns=["path", "error"])

    return read


def unreadable_files(files: DataFrame, first_rows: int | None = None) -> DataFrame:
    """Parquet files that cannot be read: path and error.

    The paths are spread over tasks; each opens its files and reads every row group, or
    only ``first_rows`` rows of each file where that is given.
    """
    return _spread(files).mapInPandas(_reader(first_rows), "path string, error string")


def _first_line(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path in batch["path"]:
            with _open(path) as source:
                start = b""
                while b"\n" not in start:
                    more = source.read(65536)
                    if not more:
                        break
                    start += more
                line = start.split(b"\n", 1)[0].rstrip(b"\r").decode("latin-1")
                rows.append((path, line))
        yield pd.DataFrame(rows, columns=["path", "header"])


def header_lines(files: DataFrame) -> DataFrame:
    """First line of each text file."""
    schema = T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("header", T.StringType())]
    )
    return _spread(files).mapInPandas(_first_line, schema)
