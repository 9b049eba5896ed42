"""Records of tab-separated files, read by byte ranges, with line ends inside quoted fields.

Where a range starts inside a quoted field a line end there ends no record, so the start of a range
does not tell what its first bytes are. But what a range does to the state of a parser is
a mapping of its few states, and mappings of neighbours can be joined:

1. every range is read once for its mapping (from each state that it may start in),
2. the mappings of a file are applied in order, one short row for each range, which gives the state
   in which each range starts,
3. every range is read for the records that start in it. The last one may end in a later range.

So a file of any size is read by as many tasks as it has ranges, and a record is found
whole wherever the ranges are cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factpanel.sources.files import _open

RANGE_BYTES = 32 << 20
#: Bytes of records that are handed on at a time.
BATCH_BYTES = 4 << 20
#: Bytes that are read at a time to find the end of the last record.
STEP_BYTES = 64 << 10

# Where a parser can stand: a quote at the start of a field opens it, a quote in an open
# field closes it unless another follows.
RECORD_START, FIELD_START, IN_FIELD, QUOTED, QUOTE_IN_QUOTED = range(5)
OPENING = re.compile(rb'[\t\n\r]"')
LINE_END = re.compile(rb"[\n\r]")
FIELD = rb'(?:"[^"]*+(?:""[^"]*+)*+(?:"[^\t\n\r]*+|\Z)|[^\t\n\r]*+)'
RECORD = re.compile(FIELD + rb"(?:\t" + FIELD + rb")*+")


def after(data: bytes, state: int) -> int:
    """The state behind data, which starts in the given one."""
    return _scan(data, state, first_end=False)[1]


def first_end(data: bytes, state: int) -> tuple[int, int]:
    """(place behind the first line end that ends a record, or -1; state there)."""
    return _scan(data, state, first_end=True)


def _scan(data: bytes, state: int, first_end: bool) -> tuple[int, int]:
    at, size = 0, len(data)
    if size and state == QUOTE_IN_QUOTED:
        # a doubled quote, or the quoted part is over
        at, state = (1, QUOTED) if data[:1] == b'"' else (0, IN_FIELD)
    elif size and state in (RECORD_START, FIELD_START):
        at, state = (1, QUOTED) if data[:1] == b'"' else (0, IN_FIELD)
    while at < size:
        if state == QUOTED:
            quote = data.find(b'"', at)
            if quote < 0:
                return -1, QUOTED
            if quote + 1 == size:
                return -1, QUOTE_IN_QUOTED
            at, state = (quote + 2, QUOTED) if data[quote + 1 : quote + 2] == b'"' else (quote + 1, IN_FIELD)
            continue
        opening = OPENING.search(data, at)
        if first_end:
            end = LINE_END.search(data, at, opening.end() if opening else size)
            if end:
                return end.end(), RECORD_START
        if opening:
            at, state = opening.end(), QUOTED
            continue
        last = data[-1:]
        return -1, RECORD_START if last in b"\n\r" else FIELD_START if last == b"\t" else IN_FIELD
    return -1, state


def cut(data: bytes) -> list[bytes]:
    """The records of data, which starts with one. Lines without text are none."""
    if b'"' not in data:
        return [r for r in re.split(rb"[\n\r]", data) if r.strip(b" ")]
    made, at = [], 0
    while at < len(data):
        end = RECORD.match(data, at).end()
        if data[at:end].strip(b" "):
            made.append(data[at:end])
        at = end + 1
    return made


def _read(source, start: int, end: int) -> bytes:
    source.seek(start)
    return source.read(end - start)


def _mappings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["path"]) as source:
                data = _read(source, row["start"], row["end"])
            made = [after(data, s) for s in range(5)] if data else list(range(5))
            yield pa.RecordBatch.from_pylist([row | {"mapping": made}], schema=_MAPPED)


_MAPPED = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("mapping", pa.list_(pa.int32()))])
_STATED = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("state", pa.int32())])


def _states(table: pa.Table) -> pa.Table:
    """The state in which each range of a file starts."""
    state, made = RECORD_START, []
    for row in table.sort_by("start").to_pylist():
        made.append({"path": row["path"], "start": row["start"], "end": row["end"], "state": state})
        state = row["mapping"][state]
    return pa.Table.from_pylist(made, schema=_STATED)


def _owned(source, start: int, end: int, state: int) -> Iterator[bytes]:
    """Bytes of the records that start in a range, whole records at a time."""
    data = _read(source, start, end)
    if state != RECORD_START:
        first, _ = first_end(data, state)
        if first < 0:
            return
        data = data[first:]
    if not data:
        return
    tail = after(data, RECORD_START)
    while tail != RECORD_START:  # the last record goes on behind the range
        more = source.read(STEP_BYTES)
        if not more:
            break
        ends, tail = first_end(more, tail)
        data += more if ends < 0 else more[:ends]
    while len(data) > BATCH_BYTES:
        ends = _last_end(data, BATCH_BYTES)
        yield data[:ends]
        data = data[ends:]
    yield data


def _last_end(data: bytes, about: int) -> int:
    """A place between two records of data, at least `about` bytes from its start."""
    ends, _ = first_end(data[about:], after(data[:about], RECORD_START))
    return len(data) if ends < 0 else about + ends


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["path"]) as source:
                header = row["start"] == 0
                for data in _owned(source, row["start"], row["end"], row["state"]):
                    found = [r.decode("latin-1") for r in cut(data)]
                    if header:
                        found, header = found[1:], False
                    if found:
                        paths = pa.array([row["path"]] * len(found), pa.string())
                        yield pa.RecordBatch.from_arrays([paths, pa.array(found, pa.string())], names=["path", "record"])


def records(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, record) of the files (path, bytes): every record but the first, which is the
    header, as Latin-1 text without the line end behind it."""
    spark = files.sparkSession
    step = F.lit(range_bytes)
    ranges = files.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / step).cast("long"))).alias("number")
    )
    ranges = ranges.select("path", (F.col("number") * step).alias("start"), F.least("bytes", (F.col("number") + 1) * step).alias("end"))
    total = files.agg(F.sum(F.ceil(F.col("bytes") / step))).first()[0] or 1
    # ranges are short rows, which would be put together in one task again without a number
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(int(total), 100_000))
    mapped = ranges.repartition(tasks, "path", "start").mapInArrow(_mappings, "path string, start long, end long, mapping array<int>")
    stated = mapped.groupBy("path").applyInArrow(_states, "path string, start long, end long, state int")
    return stated.repartition(tasks, "path", "start").mapInArrow(_records, "path string, record string")
