"""Near duplicates by MinHash, with odd sketches before an exact check.

Every document becomes the set of its word shingles. Documents with the same set are one
class, and only one of each class goes on. MinHash samples under many permutations make
band keys. MinHash samples under one permutation (the smallest hash in each of BINS bins)
are folded into an odd sketch: each sample flips one bit of a bitmap, so that samples
which two documents share cancel out in the XOR of their bitmaps, and the number of bits
left estimates how many samples differ. It is precise where few differ, that is, for the
similar pairs that matter here.

Classes that share a band key form a bucket. No bucket is expanded into its pairs: in a
few rounds each bucket names one leader, each member asks the leader whose sketch is
closest, and links that the full sets confirm are contracted into components. Members
of a bucket that are connected by then need no further check. What is left, members of
one bucket in different components, is dealt to tiles of bounded size. Inside a tile
sketches are compared, a member keeping the list of those it may be linked with, and members
with such a list meet once more with their full sets; a tile gives the links that join two
of its components. So every pair that shares a band is linked, connected by
other links, or refused by its sketch or its sets.

With 40 bands of 5 samples a pair of similarity 0.8 shares no band with probability 1e-7.
A sketch refuses a pair that shares six standard deviations fewer samples than a pair at
the threshold would, small sets more: below about 0.61 for sets of 150 shingles, 0.70 for
very large ones.

Defined cases
- A-Z is lower-cased; words are what ASCII white space separates. With fewer words than a
  shingle the whole sequence is the only element. Null texts and texts without words have
  an empty set and are linked with nothing.
- Of a component the row with the smallest doc_id stays, null ids last; of rows that are
  equal in id and text exactly one. Other columns take no part and may have any name. An
  empty table gives no rows.
- Elements are 64-bit hashes of shingles; classes are equal in a 128-bit hash of the set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.llm.common import free_name, groups_of_texts, held_by_worker, stored
from factpanel.llm.components import components

BANDS, BAND_SAMPLES = 40, 5
BINS, SKETCH_WORDS = 1024, 16
ROUNDS = 3
#: Standard deviations below the threshold at which a sketch refuses a pair.
DEVIATIONS = 6.0
#: Deviations of the normal distribution that leave 1e-7, the chance of sharing no band.
TAIL = 5.2
MOST_WORDS = 100_000
#: Members, and shingles of all of them, of one side of a tile.
TILE_ROWS, TILE_ELEMENTS = 1024, 1 << 20
TILE = ["band", "low", "high"]


class _WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


_odd = np.random.default_rng(20240607)
_PLACE = _odd.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _odd.integers(0, 1 << 31, BANDS * BAND_SAMPLES, np.uint32) * np.uint32(2) + np.uint32(1)
_TERM = _odd.integers(0, 1 << 32, BANDS * BAND_SAMPLES, np.uint32)
_BAND = _odd.integers(1, 1 << 63, (BANDS, BAND_SAMPLES), np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = held_by_worker("word hashes", _WordHashes)
    if len(hashes) > MOST_WORDS:
        hashes.clear()
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if len(each) < words:
        # the number of words tells a short sequence from a shingle
        place = _PLACE[: len(each)]
        return _mixed(np.array([(each * place).sum(dtype=np.uint64) + np.uint64(len(each))], np.uint64))
    n = len(each) - words + 1
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total += each[i : i + n] * _PLACE[i]
    return np.unique(_mixed(total))


def samples_of(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples, sets by samples; no set may be empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    made = np.empty((len(sets), len(_FACTOR)), np.uint32)
    hashed = np.empty_like(flat)
    for i, (factor, term) in enumerate(zip(_FACTOR, _TERM, strict=True)):
        np.multiply(flat, factor, out=hashed)
        np.add(hashed, term, out=hashed)
        made[:, i] = np.minimum.reduceat(hashed, starts)
    return made


def band_keys(samples: np.ndarray) -> np.ndarray:
    grouped = samples.astype(np.uint64).reshape(len(samples), BANDS, BAND_SAMPLES)
    keys = _mixed((_mixed(grouped + np.uint64(1)) * _BAND).sum(axis=2, dtype=np.uint64))
    return _mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(parity bitmaps, numbers of samples). The sample of a bin is the smallest hash in it;
    sets are sorted, so it is the first. No set may be empty."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = owner * BINS + (flat & np.uint64(BINS - 1)).astype(np.int64)
    first = np.full(len(sets) * BINS, -1, np.int64)
    first[place[::-1]] = np.arange(len(flat) - 1, -1, -1)  # the last one written stays
    first = first[first >= 0]
    owner, bits = owner[first], SKETCH_WORDS * 64
    at = owner * bits + (_mixed(flat[first]) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(sets) * bits) & 1).astype(np.uint8)
    sketches = np.packbits(odd.reshape(len(sets), bits), axis=1, bitorder="little").view(np.int64)
    return sketches, np.bincount(owner, minlength=len(sets))


class _OfColumns:
    """The functions of the sketch bounds on columns."""

    exp, log, sqrt = F.exp, F.log, F.sqrt

    @staticmethod
    def greatest(a: Column, b: Column | float) -> Column:
        return F.greatest(a, b if isinstance(b, Column) else F.lit(b))


class _OfArrays:
    """The same on arrays of numpy."""

    exp, log, sqrt, greatest = np.exp, np.log, np.sqrt, np.maximum


def _bits_apart(a: str, b: str) -> Column:
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SKETCH_WORDS)))


def _shared_samples(bits, samples, of=_OfColumns):
    """Estimate of the samples that two sets share, from the bits in which their sketches
    differ and the number of samples of both."""
    n = SKETCH_WORDS * 64
    even = of.greatest(1 - 2 * bits / float(n), 1.0 / n)
    return (samples + n / 2 * of.log(even)) / 2


def _least_shared(sizes, samples, ratio: float, of=_OfColumns):
    """How many samples a pair at the threshold shares at least, but for chance.

    A bin of the union is shared if its smallest hash is in both sets. What varies is how
    the intersection and the rest fall into the bins, given their sizes, and which flipped
    bits meet in one place. The bound is DEVIATIONS below the mean, and lower for small sets:
    they lose few samples, so the number is skewed and its tail longer than the normal one
    (Cornish and Fisher's term for it, at the quantile TAIL).
    """
    n = float(SKETCH_WORDS * 64)
    union = sizes / (1 + ratio)
    load = union / BINS  # elements of the union per bin
    empty = of.exp(-load)
    filled = 1 - empty
    expected = ratio * BINS * filled
    differ = of.greatest(samples - 2 * expected, 0.0)
    fade = of.exp(-4 * differ / n)
    spread = (n * (1 - fade) - 4 * differ * fade) / 16 * of.exp(4 * differ / n)
    # a bin is shared with chance p = lI / (lI + lD) * (1 - exp(-lI - lD)), lI and lD being the
    # elements per bin of the intersection and of the rest; as both sizes are given, the variance
    # of independent bins is less by what p changes with each
    both, rest = ratio * load, (1 - ratio) * load
    p = ratio * filled
    by_both = (1 - ratio) * filled / load + ratio * empty
    by_rest = ratio * (empty - filled / load)
    placed = BINS * (p * (1 - p) - both * by_both * by_both - rest * by_rest * by_rest)
    deviation = of.sqrt(of.greatest(spread, 0.0) + of.greatest(placed, 0.0))
    # skewness times deviation, 1 for a Poisson number; simulated 0.82 at a union of 50, 0.71 at
    # 100, 0.55 at 250, 0.29 at 500
    skewed = empty * empty
    return expected - of.greatest(DEVIATIONS * deviation, TAIL * deviation + (TAIL * TAIL - 1) / 6 * skewed)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and two hashes that name the row by its content."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", text.alias("text"),
        F.xxhash64("doc_id", text).alias("key1"), F.xxhash64(text, F.lit(17), "doc_id").alias("key2"),
    )


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, key1, key2, n_shingles, set_key, bands, sketch, samples) of every document;
    bands and sketch are null for an empty set."""
    made_kinds = [
        ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())),
        ("sketch", pa.list_(pa.int64())), ("samples", pa.int64()),
    ]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for first, group in groups_of_texts(batch.column(1).to_pylist()):
                sets = [shingle_set(t, words) for t in group]
                filled = [i for i, s in enumerate(sets) if len(s)]
                bands, sketch, keys, samples = ([x] * len(sets) for x in (None, None, b"", 0))
                if filled:
                    own = [sets[i] for i in filled]
                    bitmaps, counts = odd_sketches(own)
                    told = zip(filled, band_keys(samples_of(own)).tolist(), bitmaps.tolist(), counts.tolist(), strict=True)
                    for i, b, s, n in told:
                        bands[i], sketch[i], samples[i] = b, s, n
                        keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                made = [list(map(len, sets)), keys, bands, sketch, samples]
                columns = [batch.column(c).slice(first, len(group)) for c in (0, 2, 3)]
                columns += [pa.array(x, kind) for x, (_, kind) in zip(made, made_kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key1", "key2", *[n for n, _ in made_kinds]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, key1 long, key2 long, n_shingles long, set_key binary, bands array<long>, sketch array<long>, samples long"
    return _keyed(docs).mapInArrow(sign, made)


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(row, elements): the full sets of the rows in wanted (row, key1, key2)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["row", "elements"])

    texts = _keyed(docs).join(wanted, ["key1", "key2"]).select("row", "text")
    return texts.mapInArrow(make, "row long, elements binary")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on the full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(_alike(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("row").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("row").alias("b"), F.col("elements").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(check, "a long, b long")


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _partners(members: DataFrame, percent: int) -> DataFrame:
    """(band, low, high, row, root, partners): the members of tiles that their sketches allow
    to be linked, each pair in the list of one of its two.

    members: band, row, root, bands, sketch, samples, n_shingles. A bucket is parted by a hash
    of the row, and every two of its parts make a tile. A pair that shares several bands
    counts in the first of them only.
    """
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / TILE_ROWS), F.ceil(F.sum("n_shingles") / TILE_ELEMENTS))
    parted = members.join(members.groupBy("band").agg(parts.cast("int").alias("parts")), "band")
    parted = parted.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    tiled = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiled = tiled.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).drop("parts", "other")

    def find(table: pa.Table) -> pa.Table:
        rows, roots, parts, samples, sizes = (
            table.column(c).to_numpy() for c in ("row", "root", "part", "samples", "n_shingles")
        )
        bands, sketches = _matrix(table, "bands"), _matrix(table, "sketch").view(np.uint64)
        band, low, high = (table.column(c)[0].as_py() for c in TILE)
        right = np.flatnonzero(parts == high)
        wanted, lists = np.zeros(len(rows), bool), [[] for _ in rows]
        for a in np.flatnonzero(parts == low):
            b = right[right > a] if low == high else right
            near = (roots[b] != roots[a]) & (sizes[b] * 100 >= sizes[a] * percent) & (sizes[a] * 100 >= sizes[b] * percent)
            b = b[near]
            total = samples[b] + samples[a]
            bits = np.bitwise_count(sketches[b] ^ sketches[a]).sum(axis=1, dtype=np.int64)
            least = _least_shared(sizes[b] + sizes[a], total, percent / 100, _OfArrays)
            b = b[_shared_samples(bits, total, _OfArrays) >= least]
            b = b[bands[a][(bands[b] == bands[a]).argmax(axis=1)] == band]
            if len(b):
                wanted[a] = wanted[b] = True
                lists[a] = rows[b]
        kept = table.select([*TILE, "row", "root"]).append_column("partners", pa.array(lists, pa.list_(pa.int64())))
        return kept.filter(pa.array(wanted))

    return tiled.groupBy(*TILE).applyInArrow(find, "band long, low int, high int, row long, root long, partners array<long>")


def _joined_in_tiles(partners: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links on the full sets that join two components of a tile, fewer than its members."""

    def confirm(table: pa.Table) -> pa.Table:
        rows, roots = table.column("row").to_pylist(), table.column("root").to_pylist()
        elements = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("elements")]
        place, parent = {row: i for i, row in enumerate(rows)}, {root: root for root in roots}

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for i, others in enumerate(table.column("partners").to_pylist()):
            for b in others:
                j = place[b]
                x, y = top(roots[i]), top(roots[j])
                if x != y and _alike(elements[i], elements[j], percent):
                    parent[x] = y
                    found.append((rows[i], b))
        return pa.table({n: pa.array([f[k] for f in found], pa.int64()) for k, n in enumerate("ab")})

    return partners.join(sets, "row").groupBy(*TILE).applyInArrow(confirm, "a long, b long")


def linked_classes(docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) of the classes that are linked with another; reps: (row, key1, key2, bands,
    sketch, samples, n_shingles) of one row per class."""
    ratio = percent / 100
    members = reps.select("row", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    buckets = stored(members.join(shared, "band"), "buckets")
    rows = buckets.select("row").distinct()
    wanted = stored(reps.join(rows, "row").select("row", "key1", "key2", "bands", "sketch", "samples", "n_shingles"), "members")
    sets = stored(_full_sets(docs, wanted.select("row", "key1", "key2"), words).dropDuplicates(["row"]), "sets")
    sketches = wanted.select("row", "sketch", "samples", "n_shingles")
    samples, sizes = F.col("a_samples") + F.col("b_samples"), F.col("a_n") + F.col("b_n")
    shared = _shared_samples(_bits_apart("a_sketch", "b_sketch"), samples)
    near = (
        (shared >= _least_shared(sizes, samples, ratio))
        & (F.col("a_n") * 100 >= F.col("b_n") * percent)
        & (F.col("b_n") * 100 >= F.col("a_n") * percent)
    )

    def named(side: str) -> DataFrame:
        return sketches.select(F.col("row").alias(side), *side_columns(side))

    def side_columns(side: str) -> list[Column]:
        names = {"sketch": "sketch", "samples": "samples", "n_shingles": "n"}
        return [F.col(c).alias(f"{side}_{n}") for c, n in names.items()]

    links, labels = None, None
    for turn in range(ROUNDS):
        placed = buckets.withColumn("root", F.col("row")) if labels is None else _labelled(buckets, labels)
        order = F.struct(F.xxhash64("row", F.lit(turn)).alias("h"), "row", "root")
        leaders = placed.groupBy("band").agg(F.min(order).alias("leader"), F.min("root").alias("low"), F.max("root").alias("high"))
        leaders = leaders.where("low <> high").select("band", F.col("leader.row").alias("b"), F.col("leader.root").alias("b_root"))
        asked = placed.join(leaders, "band").where("root <> b_root").select(F.col("row").alias("a"), "b").distinct()
        asked = asked.join(named("a"), "a").join(named("b"), "b").where(near)
        likeness = (shared / sizes).alias("likeness")
        best = asked.groupBy("a").agg(F.max(F.struct(likeness, "b")).alias("best"))
        found = stored(_confirmed(best.select("a", F.col("best.b").alias("b")), sets, percent), "links")
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    # what is left of the buckets: members in different components
    placed = buckets.withColumn("root", F.col("row")) if labels is None else _labelled(buckets, labels)
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band")
    open_rows = stored(placed.join(mixed, "band").join(wanted.drop("key1", "key2"), "row"), "open")
    found = stored(_joined_in_tiles(_partners(open_rows, percent), sets, percent), "links")
    if not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return labels if labels is not None else buckets.select(F.col("row").alias("node"), F.col("row").alias("root")).limit(0)


def _labelled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    roots = labels.select(F.col("node").alias("row"), "root")
    return buckets.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))


def decisions(docs: DataFrame, words: int, percent: int = 80) -> DataFrame:
    """(doc_id, key1, key2, n_shingles, component_id, kept) of every document."""
    signed = signatures(docs, words).withColumn("row", F.monotonically_increasing_id())
    signed = stored(signed, "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    filled = signed.where("n_shingles > 0")
    classes = stored(filled.groupBy("set_key").agg(F.min(order).alias("first")), "classes")
    firsts = classes.select(F.col("first.row").alias("row"))
    reps = signed.join(firsts, "row").select("row", "key1", "key2", "bands", "sketch", "samples", "n_shingles")
    labels = linked_classes(docs, reps, words, percent)
    named = classes.withColumn("row", F.col("first.row")).join(labels.withColumnRenamed("node", "row"), "row", "left")
    named = stored(named.select("set_key", "first", F.coalesce("root", "row").alias("root")), "classes")
    lowest = named.groupBy("root").agg(F.min("first").alias("lowest"))
    owners = named.join(lowest, "root").select("set_key", "lowest")
    known = signed.select("doc_id", "key1", "key2", "n_shingles", "set_key", "row")
    joined = known.where("n_shingles > 0").join(owners, "set_key").select(
        "doc_id", "key1", "key2", "n_shingles",
        F.col("lowest.doc_id").alias("component_id"), (F.col("lowest.row") == F.col("row")).alias("kept"),
    )
    alone = known.where("n_shingles = 0").select(
        "doc_id", "key1", "key2", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return joined.unionByName(alone)


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): component_id is the smallest doc_id that the
    document is linked to, over any number of links."""
    return decisions(docs, words, percent).drop("key1", "key2")


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns."""
    told = stored(decisions(docs, words, percent).select("key1", "key2", "kept"), "kept")
    keys = told.groupBy("key1", "key2").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("stay"))
    one, two = free_name(docs, "key1"), free_name(docs, "key2")
    text = F.coalesce("text", F.lit(""))
    marked = docs.withColumns({one: F.xxhash64("doc_id", text), two: F.xxhash64(text, F.lit(17), "doc_id")})
    gone = keys.where("NOT kept").select(F.col("key1").alias(one), F.col("key2").alias(two))
    rest = marked.join(gone, [one, two], "left_anti")
    repeated = stored(keys.where("kept AND n > stay").select(F.col("key1").alias(one), F.col("key2").alias(two)), "repeated")
    if repeated.isEmpty():
        return rest.select(*docs.columns)
    # equal rows of which one stays
    single = rest.join(repeated, [one, two], "left_semi").dropDuplicates([one, two])
    return rest.join(repeated, [one, two], "left_anti").unionByName(single).select(*docs.columns)
