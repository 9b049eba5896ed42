import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factpanel.llm import grammar
from factpanel.llm.common import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 3), max_size=400), st.integers(2, 5))
@settings(max_examples=150, deadline=None)
def test_expansion_undoes_compression(ids, least):
    ids = np.array(ids, np.uint32)
    sequence, rules = grammar.compress(ids, 10, least=least, rounds=8)
    assert grammar.expand(sequence, rules, 10).tolist() == ids.tolist()
    lengths = grammar.expansion_lengths(rules, 10)
    for i, n in enumerate(lengths):
        assert len(grammar.expand(np.array([10 + i], np.uint32), rules, 10)) == n


def test_repeats_become_rules():
    ids = np.tile(np.array([5, 6, 7, 8], np.uint32), 1000)
    sequence, rules = grammar.compress(ids, 100)
    assert len(sequence) + 2 * len(rules) < len(ids) / 4


def test_pairs_of_one_bucket(monkeypatch):
    """Frequent pairs that share a bucket keep their own ranks, the most frequent first."""
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 30, 20_000).astype(np.uint64)
    pairs = (ids[:-1] << np.uint64(32)) | ids[1:]
    monkeypatch.setattr(grammar, "_buckets", lambda p: (p % np.uint64(5)).astype(np.intp))
    values, rank = grammar._ranked(pairs, 22)
    found, counts = np.unique(pairs, return_counts=True)
    order = np.argsort(-counts[counts >= 22], kind="stable")
    assert values.tolist() == found[counts >= 22][order].tolist() and 1 < len(values) < len(found)
    place = {v: i for i, v in enumerate(values.tolist())}
    assert rank.tolist() == [place.get(p, -1) for p in pairs.tolist()]


def test_counts_of_shared_buckets(monkeypatch):
    """With more pairs than an exact count is made of, pairs of one bucket are still told apart."""
    rng = np.random.default_rng(7)
    pairs = rng.zipf(1.3, 20_000).astype(np.uint64) % np.uint64(3000)
    monkeypatch.setattr(grammar, "BUCKETS", 1 << 10)
    monkeypatch.setattr(grammar, "_buckets", lambda p: (p % np.uint64(1021)).astype(np.intp))
    values, rank = grammar._ranked(pairs, 16)
    found, counts = np.unique(pairs, return_counts=True)
    order = np.argsort(-counts[counts >= 16], kind="stable")
    assert values.tolist() == found[counts >= 16][order].tolist() and 1 < len(values) < len(found)
    place = {v: i for i, v in enumerate(values.tolist())}
    assert rank.tolist() == [place.get(p, -1) for p in pairs.tolist()]


def test_no_frequent_pair_is_left():
    """A long passage that comes again and again becomes one rule, at the default."""
    rng = np.random.default_rng(3)
    passage, odd = rng.integers(0, 5000, 300), rng.integers(5000, 60_000, 4000)
    ids = np.concatenate([np.append(passage, odd[2 * i : 2 * i + 2]) for i in range(2000)]).astype(np.uint32)
    sequence, rules = grammar.compress(ids, 1 << 16)
    assert grammar.expand(sequence, rules, 1 << 16).tolist() == ids.tolist()
    _, counts = np.unique(np.stack([sequence[:-1], sequence[1:]]), axis=1, return_counts=True)
    assert counts.max() < grammar.LEAST_COUNT
    assert len(sequence) <= 3 * 2000 and grammar.expansion_lengths(rules, 1 << 16).max() == 300


@pytest.mark.parametrize("block_ids", [50, 1 << 20])
def test_files_hold_every_document(spark, odd_docs, block_ids):
    path = new_path(spark, "grammar")
    grammar.write_shards(odd_docs, path, PATH, 0, 1 << 16, block_ids)
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    expected = sorted(
        (i if i is not None else -1, zlib.crc32(np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()))
        for i, t in rows
    )
    found = grammar.document_digests(spark, path).orderBy("start").collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids_crc32) for r in found) == expected
    ids = [r.doc_id if r.doc_id is not None else -1 for r in found]
    assert ids == sorted(ids)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    whole = grammar.read_documents(spark, path).collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole)


def test_random_access(spark, odd_docs):
    path = new_path(spark, "grammar")
    grammar.write_shards(odd_docs, path, PATH, 0, 1 << 16)
    for block in spark.read.parquet(path).collect():
        block = block.asDict()
        rules = np.frombuffer(block["rules"], "<u4").reshape(-1, 2)
        ids = grammar.expand(np.frombuffer(block["sequence"], "<u4"), rules, block["first_rule"])
        at = 0
        for n in block["doc_sizes"]:
            assert grammar.decode_range(block, at, n).tolist() == ids[at : at + n].tolist()
            at += n


def test_no_documents(no_docs):
    assert grammar.encode_and_read(no_docs, PATH).collect() == []
