import hashlib

import pytest

from factpanel.llm import exact_dedup
from factpanel.llm.common import UPPER

LOWER = str.maketrans(UPPER, UPPER.lower())


def test_frequent_digests_hold_every_heavy_one(spark):
    rows = [(f"d{i % 7}" if i % 2 else f"rare{i}",) for i in range(4000)]
    found = exact_dedup.frequent_digests(spark.createDataFrame(rows, "digest string").repartition(9), counters=8)
    names = {r.digest for r in found.collect()}
    assert {"d0", "d1", "d2", "d3", "d4", "d5", "d6"} - names == set() or len(names) <= 8
    heavy = spark.createDataFrame([("x",)] * 900 + [(f"r{i}",) for i in range(3000)], "digest string").repartition(9)
    assert "x" in {r.digest for r in exact_dedup.frequent_digests(heavy, counters=8).collect()}


@pytest.mark.parametrize("counters", [1, 4, 1024])
def test_groups(odd_docs, counters):
    rows = odd_docs.select("doc_id", "text").collect()
    found = exact_dedup.duplicate_groups(odd_docs, counters).collect()
    assert len(found) == len(rows)
    groups: dict[str, list] = {}
    for r in rows:
        groups.setdefault((r.text or "").translate(LOWER), []).append(r.doc_id)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        own = digest[r.text_sha256]
        assert r.group_size == len(own)
        assert r.keep_id == max((i for i in own if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in found) == len(groups)


@pytest.mark.parametrize("counters", [1, 1024])
def test_what_stays(odd_docs, counters):
    stays = exact_dedup.drop_duplicates(odd_docs, counters)
    assert stays.columns == odd_docs.columns
    found = sorted((r.doc_id is None, r.doc_id or 0) for r in stays.collect())
    kept = exact_dedup.duplicate_groups(odd_docs, counters).where("kept").collect()
    assert found == sorted((r.doc_id is None, r.doc_id or 0) for r in kept)


def test_no_documents(no_docs):
    assert exact_dedup.duplicate_groups(no_docs).collect() == []
    assert exact_dedup.drop_duplicates(no_docs).collect() == []
