"""Helpers of the corpus operators: shared storage, batches of texts, free names."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (spark.checkpoint.dir).

    Where the setting is absent, a local session gets a temporary folder; a session with
    remote executors has to name one.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="factpanel-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as a table in the shared folder and read from there.

    What reads it starts from the files again after the loss of an executor, and sees
    the same rows each time.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


_held: dict[Hashable, Any] = {}


def held_by_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What this Python worker keeps from task to task under `key`: one thing at a time. A worker
    that is used again by another operator drops what the last one left."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release_memory() -> None:
    """Give memory that Arrow and the C library hold for later back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def slices_of_column(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """(first position, slice) of an Arrow column in order, of about `most` bytes each; a longer
    text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, texts.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, texts.slice(start)


def groups_of_column(texts: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first position, texts) of an Arrow column in order, nulls as empty texts, of about `most`
    bytes each; a longer text stands alone. Only one group is held as Python texts."""
    for start, part in slices_of_column(texts, most):
        yield start, [t or "" for t in part.to_pylist()]


def groups_of_texts(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first position, texts) in order, of about `most` characters each; a longer
    text stands alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it, so that df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
