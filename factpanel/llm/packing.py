"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A piece of length n belongs to class k = capacity // n, so k pieces of a class always
fit into one bin. Every class is dealt to shards of bounded size; each fills its bins
with k pieces in order, alone and without looking at others. What a shard cannot
complete, less than one bin, joins the leftovers of a bounded number of other shards,
which are packed by decreasing length.

Documents are cut on the way in: full sequences first; then, while the class of the
rest would waste too much, a head of exactly the next class's length. Short rests are
never cut.

Defined cases
- A null text counts as empty and is one piece that holds the end id alone.
- Rows are packed as they come: equal rows, null ids and repeated ids each get pieces
  of their own. Other columns take no part. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factpanel.llm.common import groups_of_column, stored
from factpanel.llm.pieces import cache_of

CAPACITY = 4096
#: Rests of this class and above are never cut; below it, if a bin of k rests would
#: leave more than this share of the capacity empty.
UNCUT_CLASS, EMPTY_SHARE = 16, 0.03
SHARD_ROWS, SHARD_BINS, SHARDS_TOGETHER = 8192, 16, 256
SEED = 17


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n ids, in order."""
    made = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if k >= UNCUT_CLASS or capacity - k * rest <= EMPTY_SHARE * capacity:
            made.append(rest)
            break
        head = capacity // (k + 1)
        made.append(head)
        rest -= head
    return made


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, rest: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece. With `rest` a worker gives
    most of its cache back at the end of a task, and meets more pieces again."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_of(tokenizer)
        for batch in batches:
            keys = batch.column(0)
            for first, group in groups_of_column(batch.column(1)):
                ids, sizes = cache.gather(group)
                ids = ids.astype("<u4")
                rows, starts, lengths, sums, totals = [], [], [], [], []
                at = 0
                for i, size in enumerate(sizes.tolist()):
                    own = np.append(ids[at : at + size], np.uint32(end_id))
                    at += size
                    start, data = 0, memoryview(own).cast("B")
                    for length in cut_lengths(len(own), capacity):
                        rows.append(first + i)
                        starts.append(start)
                        lengths.append(length)
                        sums.append(zlib.crc32(data[4 * start : 4 * (start + length)]))
                        totals.append(len(own))
                        start += length
                columns = [keys.take(pa.array(rows, pa.int64()))]
                columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        if rest:
            cache.rest()

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(cut, made)


def decreasing_fit(lengths: list[int], capacity: int = CAPACITY) -> list[int]:
    """The bin of each piece, by best fit of decreasing lengths."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    with_room: dict[int, list[int]] = {}
    bins, made = [0] * len(lengths), 0
    rooms = np.zeros(capacity + 1, bool)
    for i in order:
        n = lengths[i]
        fits = n + int(np.argmax(rooms[n:]))
        if rooms[fits]:
            b = with_room[fits].pop()
            rooms[fits] = bool(with_room[fits])
        else:
            b, fits, made = made, capacity, made + 1
        bins[i] = b
        if left := fits - n:
            with_room.setdefault(left, []).append(b)
            rooms[left] = True
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset. Needs doc_id, start, length (1 to capacity);
    other columns stay; names that begin with an underscore are taken."""
    order = ["doc_id", "start", *[c for c in pieces.columns if c not in ("doc_id", "start")]]
    spark = pieces.sparkSession
    # stored with the pieces, the salt is the same each time they are read; it parts equal pieces
    made = {"_class": (F.lit(capacity) / F.col("length")).cast("int"), "_salt": F.rand(SEED)}
    classed = stored(pieces.withColumns(made), "pieces")
    # one row per class, of which there are less than twice the root of the capacity
    counts = classed.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()
    deal, next_shard = [(0, 1, 0)], 0
    for k, n in sorted((r["_class"], r["n"]) for r in counts):
        shards = -(-n // max(SHARD_ROWS, SHARD_BINS * k))
        deal.append((k, shards, next_shard))
        next_shard += shards
    shards = F.broadcast(spark.createDataFrame(deal, "_class int, _shards int, _first long"))
    key = F.xxhash64("doc_id", "start", "_salt")
    dealt = classed.join(shards, "_class").withColumn("_shard", F.col("_first") + F.pmod(key, F.col("_shards")))
    in_shard = Window.partitionBy("_shard")
    row = F.row_number().over(in_shard.orderBy(*order)) - 1
    placed = dealt.withColumns({"_row": row, "_rows": F.count(F.lit(1)).over(in_shard)})
    placed = placed.withColumn("_bin", F.floor(F.col("_row") / F.col("_class")))
    full = (F.col("_bin") + 1) * F.col("_class") <= F.col("_rows")
    placed = stored(placed.withColumn("_full", full), "placed")

    in_bin = Window.partitionBy("_shard", "_bin").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.where("_full").withColumns(
        {
            "sequence_id": F.shiftleft(F.col("_shard"), 32) + F.col("_bin"),
            "offset": F.coalesce(F.sum("length").over(in_bin), F.lit(0)).cast("long"),
        }
    )
    names = [*pieces.columns, "sequence_id", "offset"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def finish(table):
        table = table.sort_by([(c, "ascending") for c in ("_shard", "_row")])
        lengths = table.column("length").to_pylist()
        group = table.column("_group")[0].as_py()
        bins = decreasing_fit(lengths, capacity)
        used: dict[int, int] = {}
        offsets = []
        for b, n in zip(bins, lengths, strict=True):
            offsets.append(used.get(b, 0))
            used[b] = offsets[-1] + n
        ids = [-1 - ((group << 32) + b) for b in bins]
        made = table.select(pieces_names)
        made = made.append_column("sequence_id", pa.array(ids, pa.int64()))
        return made.append_column("offset", pa.array(offsets, pa.int64()))

    pieces_names = pieces.columns
    rest = placed.where("NOT _full").withColumn("_group", F.floor(F.col("_shard") / SHARDS_TOGETHER))
    rest = rest.groupBy("_group").applyInArrow(finish, f"{kinds}, sequence_id long, offset long")
    return whole.select(*names).unionByName(rest.select(*names))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, rest: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity, rest), capacity)
