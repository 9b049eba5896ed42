"""Byte-level BPE by an index of pair occurrences.

The distinct words of a batch lie in one array of symbols. An index maps each rank of
a merge to all positions where its pair stands. Active ranks are applied in ascending
order: every position of the pair that still holds is merged, and the pairs that arise
left and right of it are entered under their own ranks. Words do not touch, so one pass
over the ranks encodes all words of the batch.

A rank with many positions is applied to all of them by array operations; the index then
holds its entries in arrays that are sorted by rank for a range of ranks at a time. Once the
ranks ahead have few positions each, they are applied position by position.

The order is the same as merging each word for itself, as long as a merge never uses a
symbol that only a later merge makes; that is checked when the file is read.

Defined cases
- A null text counts as empty and has no ids. Special tokens written in a text are
  found, as the tokenizers library does by default.
- Rows are encoded as they come, repeated ones and null ids included. Other columns take
  no part. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from factpanel.llm.common import groups_of_texts, held_by_worker
from factpanel.llm.pieces import BYTE_LEVEL_WORDS, MOST_WORDS, Encode, PieceCache, byte_letters

SHIFT = 20
GONE, BORDER = -2, -1
#: Ranks that are sorted at a time, and positions a rank has to have on average for arrays to pay.
RANGE, MANY = 512, 24


def _by_rank(ranks: np.ndarray, here: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(rank, its positions in the order given)."""
    order = np.argsort(ranks, kind="stable")
    ranks, here = ranks[order], here[order]
    starts = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], len(ranks)], strict=False):
        yield int(ranks[start]), here[start:end]


class PairIndexBpe:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary = told["model"]["vocab"]
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if set(token) <= letters.keys()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"] if t["special"]}
        self.bytes_of.update({i: token.encode() for token, i in self.special.items()})
        self.first = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges: dict[int, int] = {}
        self.left, self.right, self.made = [], [], []
        made_at: dict[int, int] = {}
        for rank, pair in enumerate(told["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if made_at.get(x, -1) >= rank or made_at.get(y, -1) >= rank or z in made_at:
                raise ValueError(f"merge {rank} is not in the order that an index of ranks needs")
            made_at[z] = rank
            self.merges[x << SHIFT | y] = rank
            self.left.append(x)
            self.right.append(y)
            self.made.append(z)
        if any(made_at.get(s, -1) > r for r, pair in enumerate(zip(self.left, self.right, strict=True)) for s in pair):
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = np.array(list(self.merges), np.int64)
        self.key_order = np.argsort(keys)
        self.keys = keys[self.key_order]
        self.words = regex.compile(BYTE_LEVEL_WORDS)
        found = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({found})") if found else None
        # what is letters only is one word, and no special token
        self.lettered = not any(t.isalpha() for t in self.special)
        self.known: dict[str, list[int]] = {}

    def _ranked(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ranks, positions) of the pairs that merge, of left and right symbols at positions."""
        pairs = np.where((left < 0) | (right < 0), -1, left << SHIFT | right)
        place = np.searchsorted(self.keys, pairs)
        place[place == len(self.keys)] = 0
        found = np.flatnonzero(self.keys[place] == pairs)
        return self.key_order[place[found]], at[found]

    def _merge_many(self, sym, after, before, ranks: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply ranks in ascending order while they have many positions; (ranks, positions) are
        the entries of the index, before and after."""
        while len(ranks):
            end = int(ranks.min()) + RANGE
            soon = ranks < end
            if int(soon.sum()) < MANY * len(np.unique(ranks[soon])):
                break
            index = {rank: [p] for rank, p in _by_rank(ranks[soon], here[soon])}
            later = [(ranks[~soon], here[~soon])]
            active = list(index)
            heapq.heapify(active)
            while active:
                rank = heapq.heappop(active)
                left, right, made = self.left[rank], self.right[rank], self.made[rank]
                at = np.unique(np.concatenate(index.pop(rank)))
                at = at[sym[at] == left]
                at = at[sym[after[at]] == right]
                if left == right and len(at) > 1:
                    # of a run of equal symbols every second pair
                    number = np.arange(len(at))
                    first = np.append(True, after[at[:-1]] != at[1:])
                    at = at[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]
                if not len(at):
                    continue
                taken = after[at]
                sym[at], sym[taken] = made, GONE
                beyond = after[taken]
                after[at], before[beyond] = beyond, at
                ahead = before[at]
                starts = np.concatenate([ahead, at])
                new, where = self._ranked(sym[starts], sym[np.concatenate([at, beyond])], starts)
                now = new < end
                for n, p in _by_rank(new[now], where[now]):
                    if n not in index:
                        heapq.heappush(active, n)
                    index.setdefault(n, []).append(p)
                later.append((new[~now], where[~now]))
            ranks, here = (np.concatenate(x) for x in zip(*later, strict=True))
        return ranks, here

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        ends = np.cumsum(sizes + 1)
        symbols = np.full(int(ends[-1]) + 1 if len(ends) else 1, BORDER, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[0] = False
        inside[ends] = False
        table = np.array(self.first, np.int64)
        symbols[inside] = table[np.frombuffer(b"".join(data), np.uint8)]

        # the index at the start: positions of each rank that occurs, in order
        ranks, here = self._ranked(symbols[:-1], symbols[1:], np.arange(len(symbols) - 1))
        following, previous = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        ranks, here = self._merge_many(symbols, following, previous, ranks, here)
        index = {rank: p.tolist() for rank, p in _by_rank(ranks, here)}

        sym, after, before = symbols.tolist(), following.tolist(), previous.tolist()
        active = list(index)
        heapq.heapify(active)
        merges = self.merges
        while active:
            rank = heapq.heappop(active)
            left, right, made = self.left[rank], self.right[rank], self.made[rank]
            for i in sorted(index.pop(rank)):
                if sym[i] != left:
                    continue
                j = after[i]
                if sym[j] != right:
                    continue
                sym[i], sym[j] = made, GONE
                k = after[i] = after[j]
                before[k] = i
                h = before[i]
                for start, pair in ((h, sym[h] << SHIFT | made), (i, made << SHIFT | sym[k])):
                    if (new := merges.get(pair)) is not None and sym[start] >= 0 and sym[after[start]] >= 0:
                        if new in index:
                            index[new].append(start)
                        else:
                            index[new] = [start]
                            heapq.heappush(active, new)
        result = np.array(sym, np.int64)
        kept = result >= 0
        counts = np.add.reduceat(kept, np.concatenate([[0], ends[:-1]])) if len(words) else []
        flat, start, found = result[kept].tolist(), 0, []
        for n in counts:
            found.append(flat[start : start + n])
            start += n
        return found

    def _pieces(self, text: str) -> list[str | int]:
        """Words, and ids of special tokens, in order."""
        bare = text[1:] if text.startswith(" ") else text
        if self.lettered and bare.isascii() and bare.isalpha():
            return [text]
        if self.specials is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        found: list[str | int] = []
        for part in self.specials.split(text):
            found += [self.special[part]] if part in self.special else self.words.findall(part)
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = list(map(self._pieces, texts))
        if len(self.known) > MOST_WORDS:
            self.known = {}
        new = [w for w in dict.fromkeys(chain.from_iterable(cut)) if isinstance(w, str) and w not in self.known]
        ids = dict(zip(new, self.merge_words(new), strict=True))
        # a text that is one word is kept by the caller, as a piece
        inner = set(chain.from_iterable(own for own in cut if len(own) > 1))
        self.known.update((w, i) for w, i in ids.items() if w in inner and len(w) <= 64)
        known, found = self.known, []
        for pieces in cut:
            if len(pieces) == 1 and isinstance(w := pieces[0], str):
                found.append(known[w] if w in known else ids[w])
                continue
            own: list[int] = []
            for w in pieces:
                if isinstance(w, int):
                    own.append(w)
                else:
                    own += known[w] if w in known else ids[w]
            found.append(own)
        return found

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


class SpelledCache(PieceCache):
    """Keeps the decimal ids of each piece beside the ids."""

    def __init__(self, encode: Encode):
        super().__init__(encode)
        self.spelled = [""]

    def retained(self, numbers: np.ndarray) -> None:
        self.spelled = [self.spelled[n] for n in numbers.tolist()]

    def learned(self, found: list[list[int]]) -> None:
        self.spelled += [",".join(map(str, ids)) for ids in found]


def coder_of(path: str) -> tuple[PairIndexBpe, SpelledCache]:
    """The coder and its cache in this Python worker."""

    def make() -> tuple[PairIndexBpe, SpelledCache]:
        bpe = PairIndexBpe(path)
        return bpe, SpelledCache(bpe.encode)

    return held_by_worker(("pair index", path), make)


def _mapped(docs: DataFrame, column: str, kind: str, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(batch)

    return docs.select("doc_id", column).mapInArrow(run, f"doc_id {key}, {kind}")


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of every text."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cache = coder_of(tokenizer)[1]
        for first, group in groups_of_texts([t or "" for t in batch.column(1).to_pylist()]):
            ids, counts = cache.gather(group)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            own = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), own], names=["doc_id", "ids"])

    return _mapped(docs, "text", "ids array<int>", make)


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of every row of ids; null ids give an empty text."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = coder_of(tokenizer)[0]
        texts = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return _mapped(encoded, "ids", "text string", make)


def round_trip_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text: of its ids in decimals
    with commas between, and of what the ids decode to."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe, cache = coder_of(tokenizer)
        for first, group in groups_of_texts([t or "" for t in batch.column(1).to_pylist()]):
            numbers, counts = cache.numbers(group)
            ids, sizes = cache.gather_numbers(numbers, counts)
            spelled, decoded = [], []
            piece, at = 0, 0
            for n, size in zip(counts.tolist(), sizes.tolist(), strict=True):
                words = ",".join(map(cache.spelled.__getitem__, numbers[piece : piece + n].tolist()))
                text = bpe.decode(ids[at : at + size].tolist())
                piece, at = piece + n, at + size
                spelled.append(hashlib.sha256(words.encode()).hexdigest())
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            columns = [batch.column(0).slice(first, len(group)), pa.array(sizes, pa.int64()), pa.array(spelled, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(docs, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
