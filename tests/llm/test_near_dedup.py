import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from factpanel.llm import near_dedup
from factpanel.llm.components import components


def brute(rows, words):
    """(doc_id, size, component, kept) by comparing every pair of sets."""
    sets = []
    for _, text in rows:
        found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        n = min(words, len(found))
        sets.append({tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            parent[find(a)] = find(b)
    groups: dict = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    made = []
    for own in groups.values():
        first = min(own, key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        made += [(rows[i][0], len(sets[i]), rows[first][0]) for i in own]
    return sorted(made, key=str), len(groups)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 12, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            own = [w if rng.random() > rng.choice([0, 0.02, 0.05, 0.1]) else rng.choice(words) for w in base]
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(own).upper() if family % 2 else " ".join(own)))
    rng.shuffle(rows)
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (None, "lonely words here"), (None, None), rows[0], rows[0]]


@pytest.mark.parametrize("tile_rows", [3, 1024])
def test_tiles_find_the_links_between_components(spark, monkeypatch, tile_rows):
    """Without rounds of leaders all links come from the tiles."""
    monkeypatch.setattr(near_dedup, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_dedup.near_duplicates(docs, 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, 2)[0]


def test_bounds_are_the_same_on_columns_and_arrays(spark):
    rng = np.random.default_rng(4)
    rows = [(int(n), int(s), int(b)) for n, s, b in zip(rng.integers(2, 20_000, 500), rng.integers(2, 2048, 500), rng.integers(0, 1024, 500), strict=True)]
    sizes, samples, bits = (F.col(c) for c in ("sizes", "samples", "bits"))
    shown = spark.createDataFrame(rows, "sizes long, samples long, bits long").select(
        near_dedup._shared_samples(bits, samples), near_dedup._least_shared(sizes, samples, 0.8)
    ).collect()
    n, s, b = (np.array(x) for x in zip(*rows, strict=True))
    arrays = near_dedup._OfArrays
    assert np.allclose([r[0] for r in shown], near_dedup._shared_samples(b, s, arrays))
    assert np.allclose([r[1] for r in shown], near_dedup._least_shared(n, s, 0.8, arrays))


@pytest.mark.parametrize(("seed", "words"), [(1, 2), (2, 5)])
def test_components_are_those_of_all_pairs(spark, seed, words):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key1 string, row string").repartition(3)
    found = near_dedup.near_duplicates(docs, words).collect()
    expected, groups = brute(rows, words)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == expected
    assert sum(r.kept for r in found) == groups
    stays = near_dedup.drop_near_duplicates(docs, words)
    assert stays.columns == docs.columns and stays.count() == groups


@pytest.mark.parametrize("size", [5, 150, 1000, 20_000])
def test_sketches_tell_similarity(spark, size):
    """Pairs at the threshold pass; pairs well below are refused, the closer the smaller."""
    rng = np.random.default_rng(size)

    def pair(similarity):
        common = round(2 * size * similarity / (1 + similarity))
        pool = np.unique(rng.integers(0, 1 << 63, 2 * size, np.uint64) * np.uint64(2) + rng.integers(0, 2, 2 * size, np.uint64))
        rng.shuffle(pool)
        return np.sort(pool[:size]), np.sort(np.concatenate([pool[:common], pool[size : 2 * size - common]]))

    rows = []
    for similarity in [0.81] * 60 + [0.55] * 60:
        (a, b), (n, m) = near_dedup.odd_sketches(list(pair(similarity)))
        bits = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
        rows.append((similarity, bits, int(n + m), 2 * size))
    told = spark.createDataFrame(rows, "similarity double, bits long, samples long, sizes long")
    passes = near_dedup._shared_samples(F.col("bits"), F.col("samples")) >= near_dedup._least_shared(F.col("sizes"), F.col("samples"), 0.8)
    shares = {r["similarity"]: r["share"] for r in told.groupBy("similarity").agg(F.avg(passes.cast("int")).alias("share")).collect()}
    assert shares[0.81] == 1.0
    assert shares[0.55] == 0.0 or size == 5


@pytest.mark.parametrize(("union", "pairs"), [(50, 20_000), (100, 30_000), (250, 30_000), (500, 15_000), (1000, 5_000)])
def test_no_sketch_refuses_a_pair_at_the_threshold(spark, union, pairs):
    """Of 100,000 pairs of similarity 0.80 exactly none is refused."""
    rng, common, rows = np.random.default_rng(union), union * 4 // 5, []
    middle = common + (union - common) // 2
    for _ in range(pairs // 2500):
        pool = rng.integers(0, 1 << 63, (2500, union), np.uint64) * np.uint64(2) + rng.integers(0, 2, (2500, union), np.uint64)
        left, right = np.sort(pool[:, :middle], axis=1), np.sort(np.delete(pool, range(common, middle), axis=1), axis=1)
        (a, n), (b, m) = near_dedup.odd_sketches(list(left)), near_dedup.odd_sketches(list(right))
        rows += zip(np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1).tolist(), (n + m).tolist(), strict=True)
    told = spark.createDataFrame(rows, "bits long, samples long")
    sizes = F.lit(union + common)
    passes = near_dedup._shared_samples(F.col("bits"), F.col("samples")) >= near_dedup._least_shared(sizes, F.col("samples"), 0.8)
    assert told.where(~passes).count() == 0 and len(rows) == pairs


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (260, 159), (1, 2), (2, 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 161)) and found[260] == 100
    assert found[250] == 7 and found[2] == 1 and 3 not in found


def test_no_documents(no_docs):
    assert near_dedup.near_duplicates(no_docs).collect() == []
    assert near_dedup.drop_near_duplicates(no_docs).collect() == []
