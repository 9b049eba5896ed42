import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factpanel.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.integers(1, 100_000))
@settings(max_examples=200, deadline=None)
def test_cut_lengths_add_up(n):
    made = packing.cut_lengths(n)
    assert sum(made) == n and all(0 < x <= packing.CAPACITY for x in made)


@given(st.lists(st.integers(1, 100), max_size=200))
@settings(max_examples=100, deadline=None)
def test_decreasing_fit_never_overfills(lengths):
    bins = packing.decreasing_fit(lengths, 100)
    used = np.bincount(bins, weights=lengths) if lengths else np.zeros(0)
    assert (used <= 100).all() and (used > 0).all()


@pytest.mark.parametrize("shard_rows", [4, 8192])
def test_every_id_lies_in_one_piece(odd_docs, monkeypatch, shard_rows):
    monkeypatch.setattr(packing, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(packing, "SHARD_BINS", 1)
    found = packing.pack_documents(odd_docs, PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    by_doc: dict = {}
    for r in found:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    rows = odd_docs.select("doc_id", "text").collect()
    total = 0
    for row in {(r.doc_id, r.text) for r in rows}:
        copies = sum((r.doc_id, r.text) == row for r in rows)
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[row[0], len(ids)])
        start = 0
        for at in range(0, len(own), copies):
            assert len(set(own[at : at + copies])) == 1
            _, length, crc = own[at]
            assert own[at][0] == start and zlib.crc32(ids[start : start + length].tobytes()) == crc
            start += length
        assert start == len(ids)
        total += copies * len(ids)
    places: dict = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert sum(n for own in places.values() for _, n in own) == total


def test_equal_pieces_are_dealt_to_many_shards(spark):
    pieces = spark.range(40_000).selectExpr("1L AS doc_id", "0L AS start", "900L AS length")
    found = packing.pack(pieces.repartition(5)).groupBy("sequence_id").agg({"length": "sum", "offset": "count"}).collect()
    shards = {r.sequence_id >> 32 for r in found if r.sequence_id >= 0}
    assert len(shards) == -(-40_000 // max(packing.SHARD_ROWS, packing.SHARD_BINS * 4)) > 1
    assert sum(r["count(offset)"] for r in found) == 40_000 and max(r["sum(length)"] for r in found) <= packing.CAPACITY


def test_little_padding(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ends = packing.pack_documents(documents, PATH).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in ends) / (len(ends) * packing.CAPACITY) > 0.97


def test_no_documents(no_docs):
    assert packing.pack_documents(no_docs, PATH).collect() == []
