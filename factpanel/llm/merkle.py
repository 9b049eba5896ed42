"""A Merkle manifest of a dataset with a proof for every row, by pointer jumping.

Every row is a leaf. The leaves of a source, in ascending order of doc_id, make a tree in
which ARITY consecutive nodes become their hash; the roots of the sources, in ascending
order of source, make the top tree in the same way. H is the lower-case hex SHA-256 of its
inputs in a row, digests taken as hex text.

Trees grow in blocks of ARITY ** TIER neighbours, each built by one task, and the roots of
blocks are the leaves of the next tier, so that no task ever holds a whole source. Every
node then holds a segment of its proof, the siblings before and after it on the way to its
parent. In a round each node is joined with the node it points to, adds that one's segment
to its own and points where that one pointed: after k rounds segments span 2 ** k levels,
until every leaf has reached the root.

Defined cases
- A null in any column is `-`, so it differs from an empty text. Null ids come first in a
  source, the null source first among sources. Rows of equal id are ordered by their hash;
  equal rows have equal leaves and stay separate leaves.
- A last run of fewer nodes, even of one, is hashed too; a tree of one leaf is that leaf.
- An empty table gives no rows. Columns beside the hashed ones take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.llm.common import stored
from factpanel.llm.places import numbered

ARITY = 3
#: Levels that one task builds above ARITY ** TIER neighbours.
TIER = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of the top tree count as this much higher than any level of a source's tree.
TOP = 1000


def _hashed(*values: Column) -> Column:
    """SHA-256 of the fields of a row: `-` for a null, else bytes, a colon and the value."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*told), 256))


def _depth(n: Column) -> Column:
    """Levels above n leaves: the smallest d with ARITY ** d >= n."""
    powers = [ARITY**i for i in range(64) if ARITY**i < 1 << 63]
    return sum(((n > F.lit(p)).cast("int") for p in powers), F.lit(0))


def _grown(blocks: DataFrame, base: int, kind: str) -> DataFrame:
    """The nodes over each block (grp, depth, block, items by pos): those that have their
    parent in it with their siblings, the root of a finished tree, and, with done = false, the
    root of a block whose tree goes on."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (grp, depth, block) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)):
                items = batch.column(3)[row].values
                top = min(TIER, depth - base)
                made: list[tuple] = []
                own = items.field("hash").to_pylist()
                for level in range(top + 1):
                    first = block * ARITY ** (TIER - level)
                    if level == top:
                        made.append((base + level, first, own[0], b"", b"", base + level == depth))
                        break
                    hexes = [h.hex().encode() for h in own]
                    runs = range(0, len(own), ARITY)
                    for j, h in enumerate(own):
                        run = j - j % ARITY
                        made.append((base + level, first + j, h, b"".join(own[run:j]), b"".join(own[j + 1 : run + ARITY]), True))
                    own = [hashlib.sha256(b"".join(hexes[i : i + ARITY])).digest() for i in runs]
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)]
                upper = pa.nulls(len(made) - len(items), items.field("doc_id").type)
                upper_hash = pa.nulls(len(upper), pa.binary())
                leaves = [pa.concat_arrays([items.field("doc_id"), upper]), pa.concat_arrays([items.field("checked"), upper_hash])]
                group = [pa.array([grp] * len(made), pa.int64()), pa.array([depth] * len(made), pa.int32())]
                yield pa.RecordBatch.from_arrays([*group, *columns, *leaves], names=names)

    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    names = ["grp", "depth", "level", "pos", "hash", "before", "after", "done", "doc_id", "checked"]
    schema = f"grp long, depth int, level int, pos long, hash binary, before binary, after binary, done boolean, doc_id {kind}, checked binary"
    return blocks.mapInArrow(grow, schema)


def trees(leaves: DataFrame, deepest: int) -> DataFrame:
    """All nodes over leaves (grp, depth, pos, hash, doc_id, checked); depth, of at most
    `deepest`, is that of the tree of grp. Leaves keep doc_id and checked."""
    kind = leaves.schema["doc_id"].dataType.simpleString()
    found, base, current = None, 0, leaves
    while base <= deepest:
        block = F.floor(F.col("pos") / F.lit(ARITY**TIER)).cast("long").alias("block")
        items = F.array_sort(F.collect_list(F.struct("pos", "hash", "doc_id", "checked"))).alias("items")
        # a block has at most ARITY ** TIER items
        blocks = current.groupBy("grp", "depth", block).agg(items)
        made = stored(_grown(blocks, base, kind), "nodes")
        done = made.where("done")
        found = done if found is None else found.unionByName(done)
        current, base = made.where("NOT done"), base + TIER
    return found


def _jumped(nodes: DataFrame, distance: int, leaves_only: bool) -> DataFrame:
    """One round: every node takes the segment and the pointer of the node it points to."""
    targets = nodes.where(F.col("height") >= distance).select(
        F.col("grp").alias("up_grp"), F.col("level").alias("up_level"), F.col("pos").alias("up_pos"),
        F.struct("up_grp", "up_level", "up_pos", "path", "subroot", "root").alias("next"),
    )
    if leaves_only:
        nodes = nodes.where("is_leaf")
    arrived, going = nodes.where("up_grp IS NULL"), nodes.where("up_grp IS NOT NULL")
    joined = going.join(targets, ["up_grp", "up_level", "up_pos"]).withColumns(
        {
            "path": F.concat("path", "next.path"),
            "subroot": F.coalesce("subroot", "next.subroot"),
            "root": F.coalesce("root", "next.root"),
            **{c: F.col(f"next.{c}") for c in ("up_grp", "up_level", "up_pos")},
        }
    )
    return joined.drop("next").unionByName(arrived)


def proofs(docs: DataFrame, checked_text: Column | None = None) -> DataFrame:
    """(doc_id, leaf, checked, subroot, root, path) of every row, digests as binary.

    path lists, from the leaf to the root, the siblings (before, after) of each level, each
    the digests in a row. checked is the leaf of the row with checked_text in place of text.
    """
    columns = [F.col(c) for c in FIELDS]
    other = _hashed(*columns[:-1], F.col("text") if checked_text is None else checked_text)
    leaves = docs.select("doc_id", "source", _hashed(*columns).alias("hash"), other.alias("checked"))
    placed = numbered(stored(leaves, "leaves"), ["source"], ["doc_id", "hash"], "placed")
    placed = stored(placed.withColumnRenamed("place", "pos"), "placed")
    sizes = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    sources = stored(numbered(sizes, [], ["source"], "sources"), "sources")
    groups = sources.select(F.col("source").alias("of"), (F.col("place") + 1).alias("grp"), _depth(F.col("n")).alias("depth"))
    told = groups.agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest")).first()
    n_sources, deepest = told["n"], told["deepest"] or 0
    below = trees(placed.join(groups, F.col("source").eqNullSafe(F.col("of"))), deepest)

    ends = below.where("level = depth")
    top_depth = next(d for d in range(64) if ARITY**d >= n_sources)
    no_id = F.lit(None).cast(docs.schema["doc_id"].dataType)
    top_leaves = ends.select(
        F.lit(0).cast("long").alias("grp"), F.lit(top_depth).alias("depth"), (F.col("grp") - 1).alias("pos"), "hash",
        no_id.alias("doc_id"), F.lit(None).cast("binary").alias("checked"),
    )
    above = trees(top_leaves, top_depth)

    at_end, in_top = F.col("level") == F.col("depth"), F.col("grp") == 0
    step = F.array(F.struct("before", "after"))
    # the root of a source points, over no level, to its place in the top tree
    nodes = below.unionByName(above).select(
        "grp", "level", "pos", "hash", "doc_id", "checked", (~in_top & (F.col("level") == 0)).alias("is_leaf"),
        (F.col("level") + F.when(in_top, TOP).otherwise(0)).alias("height"),
        F.when(~at_end, F.col("grp")).when(~in_top, F.lit(0).cast("long")).alias("up_grp"),
        F.when(~at_end, F.col("level") + 1).when(~in_top, F.lit(0)).alias("up_level"),
        F.when(~at_end, F.floor(F.col("pos") / F.lit(ARITY)).cast("long")).when(~in_top, F.col("grp") - 1).alias("up_pos"),
        F.when(at_end, F.slice(step, 1, 0)).otherwise(step).alias("path"),
        F.when(at_end & ~in_top, F.col("hash")).alias("subroot"), F.when(at_end & in_top, F.col("hash")).alias("root"),
    )
    distance, whole = 1, deepest + top_depth + 2  # nodes on the longest way
    while distance < whole:
        last = 2 * distance >= whole
        nodes = _jumped(nodes if distance == 1 else stored(nodes, "jumped"), distance, last)
        distance *= 2
    return nodes.where("is_leaf").select("doc_id", F.col("hash").alias("leaf"), "checked", "subroot", "root", "path")


def _hex(column: str | Column) -> Column:
    return F.lower(F.hex(column))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(_hex(s["before"]), h, _hex(s["after"])), 256))


def manifest(docs: DataFrame, checked_text: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the manifest of
    docs, and whether each row with checked_text as its text still leads to the root."""
    found = proofs(docs, checked_text)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), "")
    told = found.select(
        "doc_id", _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"), folded(_hex("checked"), F.col("path")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_ends(docs: DataFrame) -> Column:
    """text without its line ends in the rows whose id has an even checksum."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
