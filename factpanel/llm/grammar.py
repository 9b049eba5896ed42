"""Shards of token ids, compressed by a grammar of id pairs.

Documents in ascending order of id are cut into blocks of a bounded number of ids. In
each block the frequent pairs of neighbours are replaced by nonterminals, again and
again, until no pair is frequent any more. The block
keeps its rules and, for each rule, how many ids it expands to, so that a document is
decoded from its own stretch of the compressed sequence and nothing else.

One file row is one block: rules (pairs of symbols, little-endian 32 bits), the length
that each rule expands to, the compressed sequence, and per document its id and its
number of ids. Spark writes the rows as Parquet, so that a lost task leaves no
half-written file.

Defined cases
- A null text counts as empty and is the end id alone. Null ids come first, then
  ascending; rows with the same id are ordered by a hash of the text, and each is kept.
- Other columns take no part. An empty table gives files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factpanel.llm.common import new_path, release_memory, slices_of_column
from factpanel.llm.pieces import cache_of

BLOCK_IDS = 1 << 20
#: A pair has to occur this often in what is left of a block to become a rule.
LEAST_COUNT = 16
BUCKETS = 1 << 20
#: Texts that are cut into pieces at once.
GROUP_BYTES = 4_000_000


def _buckets(pairs: np.ndarray) -> np.ndarray:
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.intp)


def _ranked(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(frequent, rank): the pairs that occur at least `least` times, most frequent first,
    and at each position the rank of its pair, -1 if that is not frequent. A count of
    hashed pairs leaves out most of the rare ones, and is the count of a pair that has its
    bucket to itself; those that share one are counted exactly."""
    hashed = _buckets(pairs)
    full = np.bincount(hashed, minlength=BUCKETS) if len(pairs) > BUCKETS // 8 else None
    if full is not None:
        often = np.flatnonzero((full >= least)[hashed])
        own, hashed = pairs[often], hashed[often]
        last = np.zeros(BUCKETS, np.uint64)
        last[hashed] = own
        shared = np.zeros(BUCKETS, bool)
        shared[hashed[last[hashed] != own]] = True
        mixed = np.flatnonzero(shared[hashed])
        alone = np.flatnonzero((full >= least) & ~shared)
    else:
        often = mixed = np.arange(len(pairs))
        own = pairs
    values, counts = np.unique(own[mixed], return_counts=True)
    values, counts = values[counts >= least], counts[counts >= least]
    if full is not None:
        values, counts = np.concatenate([values, last[alone]]), np.concatenate([counts, full[alone]])
    rank = np.full(len(pairs), -1, np.int32)
    if len(values):
        values = values[np.lexsort((values, -counts))]
        # the rank of one frequent pair of each bucket; where another pair is met, the exact search
        held = np.full(BUCKETS, -1, np.int32)
        held[_buckets(values)] = np.arange(len(values), dtype=np.int32)
        found = held[hashed]
        near = found[mixed]
        other = mixed[(near >= 0) & (values[near] != own[mixed])]
        if len(other):
            order = np.argsort(values)
            at = np.searchsorted(values, own[other], sorter=order)
            at = order[np.where(at == len(values), 0, at)]
            found[other] = np.where(values[at] == own[other], at, -1)
        rank[often] = found
    return values, rank


def _chosen(rank: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Which pairs to replace: rank has the rank of each pair, -1 where it is no rule, and
    joined whether the next pair starts with the last symbol of this one. A pair goes first
    if both neighbours that overlap it rank behind; then every second one of what is still
    free in a row."""
    none = np.iinfo(rank.dtype).max
    own = np.where(rank < 0, none, rank)
    before, after = np.full_like(own, none), np.full_like(own, none)
    before[1:] = np.where(joined, own[:-1], none)
    after[:-1] = np.where(joined, own[1:], none)
    best = (rank >= 0) & (own < before) & (own < after)
    blocked = best.copy()
    blocked[1:] |= best[:-1] & joined
    blocked[:-1] |= best[1:] & joined
    where = np.flatnonzero((rank >= 0) & ~blocked)
    if len(where):
        linked = (np.diff(where) == 1) & joined[where[:-1]]
        starts = np.flatnonzero(np.concatenate([[True], ~linked]))
        run = np.repeat(starts, np.diff(np.append(starts, len(where))))
        best[where[(np.arange(len(where)) - run) % 2 == 0]] = True
    return np.flatnonzero(best)


def compress(ids: np.ndarray, first_rule: int, least: int = LEAST_COUNT, rounds: int | None = None):
    """(sequence, rules): rules[i] is the pair that symbol first_rule + i stands for, of
    ids or of earlier rules. Without `rounds` it ends when no pair is frequent.

    Symbols stay in place and are linked to the next one. A pair that was rare in a pass
    stays rare, so a pass only looks at frequent pairs that were not replaced in the one
    before, and at pairs with a new symbol.
    """
    symbols, n = ids.astype(np.uint32), len(ids)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    stands, open_ = np.ones(n, bool), np.zeros(n, bool)
    made, count, turn = [np.zeros((0, 2), np.uint32)], 0, 0
    starts = np.arange(max(0, n - 1))
    while len(starts) and (rounds is None or turn < rounds):
        if turn:
            seconds = after[starts]
            pairs = symbols[starts].astype(np.uint64)
            pairs <<= np.uint64(32)
            pairs |= symbols[seconds]
        else:
            seconds = starts + 1
            pairs = symbols[:-1].astype(np.uint64)
            pairs <<= np.uint64(32)
            pairs |= symbols[1:]
        frequent, rank = _ranked(pairs, least)
        if not len(frequent):
            break
        left = np.flatnonzero(rank >= 0)
        starts, seconds, rank = starts[left], seconds[left], rank[left]
        chosen = _chosen(rank, seconds[:-1] == starts[1:])
        number = rank[chosen]
        used = np.flatnonzero(np.bincount(number, minlength=len(frequent)))
        place = np.zeros(len(frequent), np.int64)
        place[used] = np.arange(len(used))
        number = place[number]
        rules = frequent[used]
        made.append(np.stack([rules >> np.uint64(32), rules & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        at, gone = starts[chosen], seconds[chosen]
        symbols[at] = first_rule + count + number
        stands[gone] = False
        following = after[gone]
        after[at] = following
        inside = following < n
        before[following[inside]] = at[inside]
        count, turn = count + len(used), turn + 1
        open_[starts] = True
        open_[at] = True
        previous = before[at]
        open_[previous[previous >= 0]] = True
        open_[gone] = False
        found = np.flatnonzero(open_)
        open_[found] = False
        starts = found[after[found] < n]
    return symbols[stands], np.concatenate(made)


def expansion_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """How many ids each rule stands for; a rule only uses earlier ones."""
    lengths = np.zeros(len(rules), np.int64)
    children = rules.astype(np.int64) - first_rule
    done = np.zeros(len(rules), bool)
    while not done.all():
        ready = ~done & ((children < 0) | done[np.maximum(children, 0)]).all(axis=1)
        parts = np.where(children[ready] < 0, 1, lengths[np.maximum(children[ready], 0)])
        lengths[ready] = parts.sum(axis=1)
        done |= ready
    return lengths


def expand(sequence: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that a stretch of the compressed sequence stands for. Where all rules together
    stand for no more ids than the stretch, each is taken apart once and its ids are copied."""
    lengths = expansion_lengths(rules, first_rule)
    symbols = sequence.astype(np.int64)
    sizes = np.ones(len(symbols), np.int64)
    ruled = symbols >= first_rule
    sizes[ruled] = lengths[symbols[ruled] - first_rule]
    ends = np.cumsum(sizes)
    if not len(ends) or lengths.sum() > ends[-1]:
        return _taken_apart(symbols, sizes, ends, rules, lengths, first_rule)
    each = np.arange(first_rule, first_rule + len(rules))
    rule_ends = np.cumsum(lengths)
    # ids that stand for themselves come after those of the rules
    parts = _taken_apart(each, lengths, rule_ends, rules, lengths, first_rule)
    ids = np.concatenate([parts, symbols[~ruled].astype(np.uint32)])
    starts = np.empty(len(symbols), np.int64)
    starts[ruled] = (rule_ends - lengths)[symbols[ruled] - first_rule]
    starts[~ruled] = len(parts) + np.arange(len(symbols) - int(ruled.sum()))
    index = np.repeat(starts - (ends - sizes), sizes)
    index += np.arange(len(index))
    return ids[index]


def _taken_apart(symbols: np.ndarray, sizes: np.ndarray, ends: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids of symbols, which stand for as many ids as sizes say. Each symbol is taken
    apart at the place where its ids go, so that rules of any depth cost a step per symbol."""
    places = ends - sizes
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    while len(symbols):
        ruled = symbols >= first_rule
        ids[places[~ruled]] = symbols[~ruled]
        pair, start = rules[symbols[ruled] - first_rule].astype(np.int64), places[ruled]
        first = np.ones(len(pair), np.int64)
        deeper = pair[:, 0] >= first_rule
        first[deeper] = lengths[pair[deeper, 0] - first_rule]
        symbols, places = np.concatenate([pair[:, 0], pair[:, 1]]), np.concatenate([start, start + first])
    return ids


def decode_range(block: dict, start: int, length: int) -> np.ndarray:
    """ids[start : start + length] of a block row, from the symbols that cover them."""
    rules = np.frombuffer(block["rules"], "<u4").reshape(-1, 2)
    lengths = np.frombuffer(block["rule_lengths"], "<u4").astype(np.int64)
    sequence = np.frombuffer(block["sequence"], "<u4")
    ruled = sequence >= block["first_rule"]
    sizes = np.ones(len(sequence), np.int64)
    sizes[ruled] = lengths[sequence[ruled] - block["first_rule"]]
    ends = np.cumsum(sizes)
    first = int(np.searchsorted(ends, start, side="right"))
    last = int(np.searchsorted(ends, start + length, side="left")) + 1
    skipped = int(ends[first - 1]) if first else 0
    ids = expand(sequence[first:last], rules, block["first_rule"])
    return ids[start - skipped : start - skipped + length]


SCHEMA = (
    "part int, block long, first_rule long, n_ids long, rules binary, rule_lengths binary, "
    "sequence binary, doc_ids array<{kind}>, doc_sizes array<long>"
)


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Tokenise docs, compress them and write the blocks below path. A block ends with
    the document that brings it to block_ids ids. Symbols from `vocabulary` on are rules."""

    def block(part: int, number: int, held: list, keys: list, sizes: list) -> pa.RecordBatch:
        ids = np.concatenate(held)
        sequence, rules = compress(ids, vocabulary)
        lengths = expansion_lengths(rules, vocabulary)
        packed = [x.astype("<u4").tobytes() for x in (rules, lengths, sequence)]
        columns = [pa.array([part], pa.int32()), *(pa.array([x], pa.int64()) for x in (number, vocabulary, len(ids)))]
        columns += [pa.array([x], pa.binary()) for x in packed]
        own = pa.concat_arrays(keys)
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
        columns.append(pa.array([sizes], pa.list_(pa.int64())))
        names = ["part", "block", "first_rule", "n_ids", "rules", "rule_lengths", "sequence", "doc_ids", "doc_sizes"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, part, number = cache_of(tokenizer), TaskContext.get().partitionId(), 0
        held, keys, sizes, total = [], [], [], 0
        for batch in batches:
            for first, group in slices_of_column(batch.column(1), GROUP_BYTES):
                ids, counts = cache.gather_column(group)
                at, since = 0, 0
                for i, count in enumerate(counts.tolist()):
                    held.append(np.append(ids[at : at + count], end_id))
                    at += count
                    sizes.append(count + 1)
                    total += count + 1
                    if total >= block_ids:
                        keys.append(batch.column(0).slice(first + since, i + 1 - since))
                        yield block(part, number, held, keys, sizes)
                        held, keys, sizes, total, number, since = [], [], [], 0, number + 1, i + 1
                if since < len(group):
                    keys.append(batch.column(0).slice(first + since, len(group) - since))
        if held:
            yield block(part, number, held, keys, sizes)
        release_memory()

    # the sample that sets the ranges holds these columns only, and no texts
    rows = docs.select("doc_id", "text").withColumn("hash", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    rows = rows.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows.mapInArrow(blocks, SCHEMA.format(kind=kind)).write.parquet(path)


def ids_before(blocks: DataFrame) -> DataFrame:
    """(part, block, before): how many ids of the shards come before each block."""
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # one row per written file, so the window without keys holds as many rows as files
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(over_parts), F.lit(0)).alias("parts_before"))
    over_blocks = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("blocks_before", F.coalesce(F.sum("n_ids").over(over_blocks), F.lit(0)))
    before = (F.col("parts_before") + F.col("blocks_before")).alias("before")
    return sizes.join(parts, "part").select("part", "block", before)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, int, int, list[int], memoryview]]:
    """Of each block: document ids, its part and number, ends of the documents, all ids."""
    for batch in batches:
        for row in range(batch.num_rows):
            rules, sequence = (np.frombuffer(batch.column(c)[row].as_buffer(), "<u4") for c in ("rules", "sequence"))
            ids = expand(sequence, rules.reshape(-1, 2), batch.column("first_rule")[row].as_py())
            ends = np.cumsum(batch.column("doc_sizes")[row].values.to_numpy()).tolist()
            data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            part, number = (batch.column(c)[row].as_py() for c in ("part", "block"))
            yield batch.column("doc_ids")[row].values, part, number, ends, data


def _read(spark: SparkSession, path: str, column: str, kind: str, make, arrow_kind) -> DataFrame:
    """(doc_id, start, n_tokens, column): make gets the bytes of a document's ids."""
    blocks = spark.read.parquet(path)
    key = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, part, number, ends, data in _documents(batches):
            starts, n = [0, *ends[:-1]], len(ends)
            sizes = [b - a for a, b in zip(starts, ends, strict=True)]
            made = [make(data[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
            place = [pa.array([part] * n, pa.int32()), *(pa.array(x, pa.int64()) for x in ([number] * n, starts, sizes))]
            yield pa.RecordBatch.from_arrays([keys, *place, pa.array(made, arrow_kind)], names=names)

    names = ["doc_id", "part", "block", "inside", "n_tokens", column]
    rows = blocks.select("part", "block", "doc_ids", "doc_sizes", "first_rule", "rules", "sequence")
    decoded = rows.mapInArrow(decode, f"doc_id {key}, part int, block long, inside long, n_tokens long, {column} {kind}")
    # only what was decoded is joined: the blocks themselves are not moved
    start = (F.col("before") + F.col("inside")).alias("start")
    return decoded.join(ids_before(blocks), ["part", "block"]).select("doc_id", start, "n_tokens", column)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, decoded from the files: start counts
    the ids of all documents before it, ids are little-endian 32-bit integers."""
    return _read(spark, path, "ids", "binary", bytes, pa.binary())


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    return _read(spark, path, "ids_crc32", "long", zlib.crc32, pa.int64())


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0, vocabulary: int = 1 << 16) -> DataFrame:
    """Write docs to files in the shared folder and read the digests of their ids back."""
    path = new_path(docs.sparkSession, "grammar")
    write_shards(docs, path, tokenizer, end_id, vocabulary)
    return document_digests(docs.sparkSession, path)
