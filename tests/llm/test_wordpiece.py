import json

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers.models import WordPiece

from factpanel.llm import wordpiece
from factpanel.llm.pieces import byte_letters

PATH = public_tokenizers.path("byte_bpe_50k.json")
SHORT = st.text("abc", min_size=1, max_size=5).map(str.encode)


def greedy(word, starts, inner):
    n = at = 0
    known = starts
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return -1
        n, at, known = n + 1, end, inner
    return n


@given(st.sets(SHORT, max_size=12), st.none() | st.sets(SHORT, max_size=12), st.lists(st.text("abc", max_size=14), max_size=20))
@settings(max_examples=300, deadline=None)
def test_counts_are_those_of_the_greedy_match(starts, inner, words):
    automaton = wordpiece.LongestMatch(sorted(starts), None if inner is None else sorted(inner))
    for word in map(str.encode, words):
        assert automaton.count(word) == greedy(word, starts, starts if inner is None else inner)


def test_counts_are_those_of_the_library(odd_docs):
    with open(PATH, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    model = WordPiece(vocab=vocabulary | {"[unknown]": 60000}, unk_token="[unknown]", max_input_chars_per_word=10**6, continuing_subword_prefix="")
    letter = {b: c for c, b in byte_letters().items()}

    def pieces(word):
        return len(model.tokenize("".join(letter[b] for b in b" " + word)))

    expected = []
    for r in odd_docs.select("doc_id", "text").collect():
        words = (r.text or "").encode().split()
        count = {w: pieces(w) for w in set(words)}
        expected.append((r.doc_id, len(words), sum(count[w] for w in words), 0))
    found = wordpiece.count_tokens(odd_docs, PATH).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_no_documents(no_docs):
    assert wordpiece.count_tokens(no_docs, PATH).collect() == []
