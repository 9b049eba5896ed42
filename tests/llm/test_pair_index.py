import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factpanel.llm import common, pair_index, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def told(texts):
    tokenizer, made = Tokenizer.from_file(PATH), {}
    for text in set(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        made[text] = (len(ids), digest(",".join(map(str, ids))), digest(decoded))
    return made


def test_digests_are_those_of_the_library(odd_docs):
    rows = odd_docs.collect()
    known = told([r.text for r in rows])
    found = pair_index.round_trip_digests(odd_docs, PATH).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((r.doc_id, *known[r.text]) for r in rows), key=str)


def test_ids_and_texts_come_back(odd_docs):
    encoded = pair_index.encode_documents(odd_docs, PATH)
    back = pair_index.decode_documents(encoded, PATH)
    expected = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    none = encoded.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert {r.text for r in pair_index.decode_documents(none, PATH).collect()} == {""}


@pytest.mark.parametrize("bounds", [(3, 600_000, 3), (600_000, 40, 2), (50, 10_000, 100_000)])
def test_small_caches_give_the_same(odd_texts, monkeypatch, bounds):
    monkeypatch.setattr(pieces, "MOST_PIECES", bounds[0])
    monkeypatch.setattr(pieces, "MOST_CHARS", bounds[1])
    monkeypatch.setattr(pair_index, "MOST_WORDS", bounds[2])
    bpe = pair_index.PairIndexBpe(PATH)
    cache, known = pair_index.SpelledCache(bpe.encode), told(odd_texts)
    for _ in range(2):
        for start in range(0, len(odd_texts), 30):
            group = odd_texts[start : start + 30]
            numbers, counts = cache.numbers([t or "" for t in group])
            ids, sizes = cache.gather_numbers(numbers, counts)
            at = piece = 0
            for text, n, size in zip(group, counts.tolist(), sizes.tolist(), strict=True):
                spelled = [cache.spelled[x] for x in numbers[piece : piece + n].tolist()]
                own = ids[at : at + size].tolist()
                assert known[text] == (size, digest(",".join(map(str, own))), digest(bpe.decode(own)))
                assert digest(",".join(s for s in spelled if s)) == known[text][1]
                piece, at = piece + n, at + size


def test_a_full_cache_keeps_the_pieces_met_most(monkeypatch):
    cache = pieces.PieceCache(lambda texts: [[len(t)] for t in texts])
    cache.numbers(["a b c d e f", "x b c", "x b c"])
    monkeypatch.setattr(pieces, "MOST_PIECES", 5)
    cache.numbers([])
    assert set(cache.known) == {"b", "c"}


def test_a_worker_holds_one_thing():
    first = common.held_by_worker("one", list)
    assert common.held_by_worker("one", list) is first
    common.held_by_worker("two", list)
    assert common.held_by_worker("one", list) is not first


def test_no_documents(no_docs):
    assert pair_index.round_trip_digests(no_docs, PATH).collect() == []
    assert pair_index.encode_documents(no_docs, PATH).collect() == []
