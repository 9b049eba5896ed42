import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factpanel.llm import pieces
from factpanel.llm.pair_index import PairIndexBpe


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("most", [3, 600_000])
def test_ids_are_those_of_the_library(name, most, odd_texts, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_PIECES", most)
    path = public_tokenizers.path(name)
    cache, tokenizer = pieces.library_cache(path), Tokenizer.from_file(path)
    texts = [t or "" for t in odd_texts]
    for _ in range(2):
        for group in (texts[:100], texts[100:]):
            ids, counts = cache.gather(group)
            at = 0
            for text, n in zip(group, counts, strict=True):
                assert ids[at : at + n].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:50]
                at += n


def test_pair_index_is_the_library(odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, tokenizer = PairIndexBpe(path), Tokenizer.from_file(path)
    texts = [t or "" for t in odd_texts]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False) == text


def test_a_cache_rests(odd_texts, monkeypatch):
    """Between tasks a cache holds few pieces, and ids stay those of the library."""
    monkeypatch.setattr(pieces, "MOST_PIECES", 80)
    monkeypatch.setattr(pieces, "LEARNED_AT_ONCE", 7)
    path = public_tokenizers.path("byte_bpe_50k.json")
    cache, tokenizer = pieces.library_cache(path), Tokenizer.from_file(path)
    texts = [t or "" for t in odd_texts] + ["néé, the. (the) it's. a,' the's%%%", "the the. the, thé"]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, counts = cache.gather(texts)
        assert ids.tolist() == sum(expected, []) and counts.tolist() == [len(e) for e in expected]
        cache.rest()
        assert len(cache.known) <= 80 // pieces.RESTING


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("most", [3, 600_000])
def test_ids_of_a_column(name, most, odd_texts, monkeypatch):
    """Slices of an Arrow column with nulls give the ids of the library."""
    monkeypatch.setattr(pieces, "MOST_PIECES", most)
    path = public_tokenizers.path(name)
    cache, tokenizer = pieces.library_cache(path), Tokenizer.from_file(path)
    texts = [*odd_texts, "the the, the,. (the) né, né é,' the's, a<| ×, ª. ß!? ́, 1, 日,", None]
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for first, last in ((0, 1), (0, 100), (8, 9), (100, len(texts)), (0, len(texts))):
        ids, counts = cache.gather_column(column.slice(first, last - first))
        assert ids.tolist() == sum(expected[first:last], [])
        assert counts.tolist() == [len(e) for e in expected[first:last]]


COLUMN_PATH = public_tokenizers.path("byte_bpe_50k.json")
COLUMN_CACHE, COLUMN_TOKENIZER = pieces.library_cache(COLUMN_PATH), Tokenizer.from_file(COLUMN_PATH)
PARTS = ["a", "the", "É", "×", "ª", "ʰ", "1", " ", "\n", "  ", "\t", ",", ".", "'", "'s", "<|", "|>", "<|endoftext|>", "€", "\u0301", "日"]


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_column(texts):
    ids, counts = COLUMN_CACHE.gather_column(pa.array(texts, pa.string()))
    expected = [COLUMN_TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(expected, []) and counts.tolist() == [len(e) for e in expected]


def test_signs_after_known_words_are_not_encoded_again():
    """In a column, a word is encoded once, whatever signs come after it."""
    cache, asked = pieces.library_cache(COLUMN_PATH), []
    encode = cache.encode
    cache.encode = lambda texts: asked.extend(texts) or encode(texts)
    cache.gather_column(pa.array(["x thing thing, thing. thing!! other, other."]))
    assert sorted(asked) == sorted([" other", " thing", "!!", ",", ".", "x"])
