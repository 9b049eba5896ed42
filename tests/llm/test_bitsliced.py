import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from factpanel.llm import bitsliced


@pytest.mark.parametrize(("n", "width", "low", "high"), [(300, 5, -9, 9), (400, 64, -30, 30), (70, 3, 0, 1), (5, 2, 5, 6), (64, 1, -1, 1)])
@pytest.mark.parametrize("k", [1, 20])
def test_block_search_is_exact(n, width, low, high, k):
    rng = np.random.default_rng(n)
    values, ids = rng.integers(low, high + 1, (n, width)), np.arange(n)
    query, row, score = bitsliced.search_block(ids[::7], values[::7], ids, values, k)
    for q in ids[::7]:
        scores = values @ values[q]
        best = [j for j in np.lexsort((ids, -scores)) if j != q][:k]
        own = query == q
        order = np.lexsort((row[own], -score[own]))
        assert row[own][order].tolist() == best and score[own][order].tolist() == scores[best].tolist()


def test_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(60 + i, [300_000.0 * (i - 2), -0.5, 20_000_000.0, 1e-3 * i]) for i in range(5)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    expected = []
    for q in range(0, 65, 20):
        scores = {i: sum(a * b for a, b in zip(whole[q], v, strict=True)) for i, v in whole.items() if i != q}
        best = sorted((-s, i) for i, s in scores.items())[:20]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    found = bitsliced.search(vectors, F.col("vec_id") % 20 == 0, block_rows=16).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_scores_that_no_long_can_hold(spark):
    vectors = spark.createDataFrame([(0, [1e12]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64-bit"):
        bitsliced.search(vectors, F.col("vec_id") % 20 == 0)


@pytest.mark.parametrize("block_rows", [16, 8192])
def test_search(spark, block_rows):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=6) / 2], "x") for i in range(150)]
    rows += [(200 + i, rows[0][1], "x") for i in range(40)]  # ties
    rows += [(300, None, "x"), (320, [0.1, None, 0.2], "x"), (340, [float("nan")], "x"), (360, [math.inf], "x"), (None, [1.0], "x")]
    rows += [(380, [], "x"), (400, [0.5, -0.25], "x"), rows[3], rows[20]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(3)
    found = bitsliced.search(vectors, F.col("vec_id") % 20 == 0, block_rows=block_rows, block_queries=4).collect()
    usable = [
        (i, np.pad(np.floor(64 * np.float32(v).astype(np.float64)), (0, 6 - len(v))).astype(np.int64))
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    expected = []
    for q, own in {i: v for i, v in usable if i % 20 == 0}.items():
        best = sorted((-int(own @ v), i) for i, v in usable if i != q)[:20]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_equal_rows_are_dealt_to_many_blocks(spark):
    same = [(7, [0.5, 0.25])] * 400 + [(20, [1.0, 1.0])]
    vectors = spark.createDataFrame(same, "vec_id long, embedding array<float>").repartition(3)
    found = bitsliced.search(vectors, F.col("vec_id") % 20 == 0, block_rows=32).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [
        (20, n + 1, 7, 64 * 32 + 64 * 16) for n in range(20)
    ]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bitsliced.search(none, F.col("vec_id") % 20 == 0).collect() == []
