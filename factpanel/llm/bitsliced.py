"""Exact top-k by inner product over a bit-sliced index.

Vectors are integers per component. The rows of a block are held as bitmaps: for each
component one bitmap per bit, slice b has bit r set if row r has bit b. A query's score
of all rows of the block at once is a sum of slices, each shifted by the bits of the
query's component, and is added up by carry-save steps of AND, XOR and OR over whole
bitmaps. From the slices of the sum the best rows are taken from the most significant
slice down; where a slice splits the rows at the boundary, the next ones decide, and
rows with the very same score are taken by ascending id.

Negative numbers: components are shifted by the smallest value of the block, and for a
negative query component the complement of the shifted value is added instead. Both
only move the scores of a query in a block by a constant, which is taken off again.

Queries and rows are dealt to blocks of bounded size; each pair of blocks is one group
of work, which returns at most k rows per query.

Defined cases
- Vectors that are null, or hold a null or a non-finite component, take no part; an empty
  vector scores 0 with all. Components that one of two vectors lacks count as 0.
- A component x becomes floor(scale * x), of any size for which every score is sure to be a
  64-bit integer: the number of slices follows from the data. Beyond that the search raises, as
  its score column could not hold the result.
- Equal scores go to the smaller id. A query finds every row but those with its own id;
  rows with a null id take no part. Repeated rows are candidates each, and a repeated
  query is answered once. Other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factpanel.llm.common import stored

BLOCK_ROWS, BLOCK_QUERIES = 8192, 512
SEED, SALTS = 17, 1 << 30


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bitmaps, complements, tops) of non-negative integers, rows by components.
    bitmaps[c, b] is slice b of component c; the complement is of tops[c] - value."""
    tops = values.max(axis=0) if len(values) else np.zeros(values.shape[1], np.int64)
    bits = max(1, int(tops.max(initial=0)).bit_length())

    def packed(v: np.ndarray) -> np.ndarray:
        planes = ((v.T[:, None, :] >> np.arange(bits)[None, :, None]) & 1).astype(np.uint8)
        bytes_ = np.packbits(planes, axis=2, bitorder="little")
        room = -bytes_.shape[2] % 8
        return np.ascontiguousarray(np.pad(bytes_, ((0, 0), (0, 0), (0, room)))).view(np.uint64)

    return packed(values), packed(tops - values), tops


def added(levels: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of bitmaps: levels[w] holds stacks of bitmaps that weigh 2^w."""
    result = []
    w = 0
    while levels:
        stacks = levels.pop(w, None)
        if stacks is None:
            if not levels:
                break
            result.append(None)
            w += 1
            continue
        rows = np.concatenate(stacks) if len(stacks) > 1 else stacks[0]
        carried = []
        while len(rows) > 2:
            third = len(rows) // 3
            a, b, c, rest = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third], rows[3 * third :]
            differ = a ^ b
            carried.append((a & b) | (c & differ))
            np.bitwise_xor(differ, c, out=differ)
            rows = np.concatenate([differ, rest]) if len(rest) else differ
        if len(rows) == 2:
            carried.append((rows[:1] & rows[1:]))
            rows = rows[:1] ^ rows[1:]
        result.append(rows[0])
        if carried:
            levels.setdefault(w + 1, []).extend(carried)
        w += 1
    return result


def score_slices(query: np.ndarray, bitmaps: np.ndarray, complements: np.ndarray) -> list[np.ndarray]:
    """Slices of sum(|q| * v), v the shifted component or, for q < 0, its complement."""
    levels: dict[int, list[np.ndarray]] = {}
    size = np.abs(query)
    bits = bitmaps.shape[1]
    for shift in range(int(size.max(initial=0)).bit_length()):
        has = (size >> shift) & 1 == 1
        stack = np.concatenate([bitmaps[has & (query > 0)], complements[has & (query < 0)]])
        if len(stack):
            for b in range(bits):
                levels.setdefault(shift + b, []).append(stack[:, b])
    return added(levels)


def top_rows(slices: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows among `alive` (a bitmap), ties to the lower position."""
    sure, edge = np.zeros_like(alive), alive.copy()
    found, count = 0, int(np.bitwise_count(edge).sum())
    if count > k:
        for bitmap in reversed(slices):
            if bitmap is None:
                continue
            better = edge & bitmap
            n = int(np.bitwise_count(better).sum())
            if found + n > k:
                edge = better
            else:
                sure |= better
                found += n
                edge &= ~bitmap
            if found == k:
                edge[:] = 0
                break
    positions = [np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little")) for x in (sure, edge)]
    return np.concatenate([positions[0], positions[1][: max(0, k - found)]])


def scores_at(slices: list[np.ndarray], positions: np.ndarray) -> np.ndarray:
    total = np.zeros(len(positions), np.int64)
    word, bit = positions >> 6, (positions & 63).astype(np.uint64)
    for w, bitmap in enumerate(slices):
        if bitmap is not None:
            total += ((bitmap[word] >> bit) & np.uint64(1)).astype(np.int64) << w
    return total


def search_block(query_ids, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int):
    """(query ids, row ids, scores): the k best rows of the block for each query. ids
    ascend; values and queries are integers, rows by components."""
    low = values.min(axis=0)
    bitmaps, complements, tops = slices_of(values - low)
    everyone = np.full(bitmaps.shape[2], np.uint64(0xFFFFFFFFFFFFFFFF))
    spare = len(everyone) * 64 - len(ids)
    bits = np.unpackbits(everyone.view(np.uint8), bitorder="little")
    bits[len(bits) - spare :] = 0
    everyone = np.packbits(bits, bitorder="little").view(np.uint64)
    out_query, out_row, out_score = [], [], []
    for q, query in zip(query_ids, queries, strict=True):
        # sum(q * v) = sum(q * low) + sum(|q| * shifted) - sum(|q| * top, where q < 0)
        base = int(query @ low) + int(query[query < 0] @ tops[query < 0])
        slices = score_slices(query, bitmaps, complements)
        alive = everyone.copy()
        for own in range(int(np.searchsorted(ids, q)), int(np.searchsorted(ids, q, side="right"))):
            alive[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        rows = top_rows(slices, alive, k)
        out_query.append(np.full(len(rows), q))
        out_row.append(ids[rows])
        out_score.append(base + scores_at(slices, rows))
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_query, out_row, out_score)]
    return joined


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.values.to_numpy()[offsets[0] : offsets[-1]]
    made = np.zeros((len(sizes), width), np.int64)
    made[np.arange(width)[None, :] < sizes[:, None]] = flat
    return made


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(doubles, lambda x: F.floor(x * scale))
    return F.when(vector.isNotNull() & ~bad, whole)


def search(
    vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `vectors` (vec_id, embedding) where
    `queries` holds, its k best other rows."""
    rows = vectors.where("vec_id IS NOT NULL").select(
        "vec_id", quantised(F.col("embedding"), scale).alias("vector"), queries.alias("asks")
    )
    # stored with the vectors, the salt is the same each time they are read; it parts equal rows
    salted = rows.where("vector IS NOT NULL").withColumn("salt", (F.rand(SEED) * SALTS).cast("int"))
    rows = stored(salted, "vectors")
    ends = [F.min(F.array_min("vector")), F.max(F.array_max("vector"))]
    size = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1)), F.max(F.size("vector")), *ends).first()
    top = max(-(size[3] or 0), size[4] or 0)
    if top * top * (size[2] or 0) >= 1 << 63:
        raise ValueError("components are so large that a score may not be a 64-bit integer")
    row_blocks, query_blocks, width = -(-size[0] // block_rows) or 1, -(-size[1] // block_queries) or 1, max(1, size[2] or 0)

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", "salt"), F.lit(own_blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
        return df.withColumn(own, block).drop("salt").withColumn(other, every)

    asking = rows.where("asks").dropDuplicates(["vec_id", "vector"]).select("vec_id", "vector", F.lit(0).alias("salt"))
    asking = dealt(asking, "query_block", query_blocks, "row_block", row_blocks)
    asked = dealt(rows.select("vec_id", "vector", "salt"), "row_block", row_blocks, "query_block", query_blocks)

    def work(queries, candidates):
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        candidates = candidates.sort_by("vec_id")
        ids = candidates.column("vec_id").to_numpy().astype(np.int64)
        asking_ids = queries.column("vec_id").to_numpy().astype(np.int64)
        found = search_block(asking_ids, _matrix(queries, width), ids, _matrix(candidates, width), k)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), found, strict=True)})

    keys = ["query_block", "row_block"]
    best = asking.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(work, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
