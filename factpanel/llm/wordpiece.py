"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry at the start of a word, then the
longest at the start of the rest, and so on. The vocabulary is a trie. Each node has a
failure link, where matching goes on after the pieces that the characters up to the
node must end in, and the number of those pieces, both computed once. So a word is
counted in one pass over its bytes, without going back and without building a piece.

A word is what ASCII white space separates, with one space before it, as byte-level
vocabularies mark the start of a word.

Defined cases
- A null text counts as empty and has no words. A word that the vocabulary cannot spell
  counts as one token and one unknown word.
- Rows are counted as they come, repeated ones and null ids included. Other columns take
  no part. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from factpanel.llm.common import groups_of_texts, held_by_worker
from factpanel.llm.pieces import byte_letters

MOST_WORDS = 300_000
NONE = -1


class LongestMatch:
    """An automaton over bytes. Words start at the first root, where the pieces of `starts`
    begin; the rest of a word goes on at the second, with the pieces of `inner`. Both are
    one root if inner is not given."""

    def __init__(self, starts: Iterable[bytes], inner: Iterable[bytes] | None = None):
        self.next: dict[int, int] = {}
        self.first, self.rest = 0, 0 if inner is None else 1
        self.fail, self.popped = [NONE] * (self.rest + 1), [0] * (self.rest + 1)
        parent, last, ends = [NONE] * (self.rest + 1), [0] * (self.rest + 1), [False] * (self.rest + 1)
        for root, pieces in ((self.first, starts), (self.rest, inner or ())):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.next:
                        self.next[key] = len(parent)
                        parent.append(node)
                        last.append(byte)
                        ends.append(False)
                    node = self.next[key]
                if piece:
                    ends[node] = True
        n = len(parent)
        self.fail, self.popped = [NONE] * n, [0] * n
        depth = [0] * n
        for node in range(self.rest + 1, n):  # a parent comes before its children
            depth[node] = depth[parent[node]] + 1
        for node in sorted(range(self.rest + 1, n), key=depth.__getitem__):
            if ends[node]:
                self.fail[node], self.popped[node] = self.rest, 1
                continue
            at, byte = parent[node], last[node]
            popped = self.popped[at]
            at = self.fail[at]
            while at != NONE and at << 8 | byte not in self.next:
                popped += self.popped[at]
                at = self.fail[at]
            if at != NONE:
                self.fail[node], self.popped[node] = self.next[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """The number of greedy pieces of a word, or -1 if it cannot be spelled."""
        step, fail, popped = self.next, self.fail, self.popped
        node, total = self.first, 0
        for byte in word:
            while (to := step.get(node << 8 | byte)) is None:
                total += popped[node]
                node = fail[node]
                if node == NONE:
                    return NONE
            node = to
        while node not in (self.first, self.rest):
            total += popped[node]
            node = fail[node]
            if node == NONE:
                return NONE
        return total


def byte_level_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file, without its special tokens."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letters = byte_letters()
    special = {t["content"] for t in told["added_tokens"]}
    return [bytes(letters[c] for c in token) for token in told["model"]["vocab"] if token not in special]


class _Counts(dict):
    """Counts of words, remembered; a word that cannot be spelled has 1 and is noted."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton, self.unknown = automaton, set()

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if n == NONE:
            self.unknown.add(word)
            n = 1
        self[word] = n
        return n


def counter_of(path: str) -> _Counts:
    """The counter of this Python worker."""
    counts = held_by_worker(("longest match", path), lambda: _Counts(LongestMatch(byte_level_pieces(path))))
    if len(counts) > MOST_WORDS:
        counts.clear()
        counts.unknown.clear()
    return counts


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tokens, unknown = [], [], []
            for _, group in groups_of_texts([t or "" for t in batch.column(1).to_pylist()]):
                counts = counter_of(vocabulary)
                for text in group:
                    own = text.encode().split()
                    words.append(len(own))
                    tokens.append(sum(map(counts.__getitem__, own)))
                    unknown.append(sum(map(counts.unknown.__contains__, own)) if counts.unknown else 0)
            made = [pa.array(x, pa.int64()) for x in (words, tokens, unknown)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
