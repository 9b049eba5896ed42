"""Alignment of the tokens of two tokenizers over the bytes of whole texts, by pointer jumping.

Tokenizer A is a byte-level file of the tokenizers library and gets the text with a space
before it; B is a sentencepiece model that puts that space itself. Tokens of A and B are
nodes. Every token points to the farthest-right token of the other side that it overlaps,
and a token beyond which nothing of its group reaches is the end of the group. Pointers are
doubled (each takes what its target points to) as one array operation over the tokens
of many texts, until nothing changes; then the ends label the groups, and all tokens
between two common ends have the same label.

Both tokenizers start a new token at a space or line end between two other characters. So
texts are cut there, each distinct piece is encoded and aligned once in a worker, and what
belongs to a text is gathered from its pieces.

The links of a pair of ids are counted over all texts. The texts go in bounded batches that
are stored, each with its distinct pairs and how often its texts have them. The pairs
of all batches are counted by Spark, and the counts come back to the batches that ask for
them. No table of pairs is held whole by a task or sent to all.

Defined cases
- Texts that are null or empty, and texts that one of the tokenizers does not give back byte
  by byte, have no tokens: zeros and an empty string.
- Special tokens written in a text are plain text.
- Repeated rows are separate rows, and their links count each time. Ids may be null or
  repeated. Columns beside doc_id and text take no part. An empty table gives no rows.
- A very long text is a batch of its own; a text without spaces is one piece.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factpanel.llm.common import groups_of_column, held_by_worker, release_memory, stored
from factpanel.llm.pieces import _library_encode, byte_letters

#: Bounds of what a worker keeps of pieces that it has met.
MOST_PIECES, MOST_LINKS = 150_000, 2_000_000
#: Of these bounds, the share that it holds between two tasks; new pieces learned at once.
RESTING, LEARNED_AT_ONCE = 4, 20_000
#: Characters of a batch of texts.
BATCH_CHARS = 2_000_000
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: A pair of ids as one number: id of A times PAIR, plus id of B.
PAIR = 1 << 31


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The group of each token, A's before B's, named by the last B token in it. Ends are byte
    offsets, ascending; both sides end at the same offset."""
    n = len(ends_a)
    farthest_b = np.searchsorted(ends_b, ends_a)  # holds the last byte of the token
    farthest_a = np.searchsorted(ends_a, ends_b)
    own = np.arange(n, n + len(ends_b))
    # where A reaches no further, the B token is the end of its group
    points = np.concatenate([farthest_b + n, np.where(ends_a[farthest_a] > ends_b, farthest_a, own)])
    while True:
        further = points[points]
        if np.array_equal(further, points):
            return points - n
        points = further


def links_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of all overlaps, in the order of A."""
    starts_a = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, starts_a, side="right")
    counts = np.searchsorted(ends_b, ends_a) - first + 1
    after = np.cumsum(counts)
    left = np.repeat(np.arange(len(ends_a)), counts)
    return left, np.arange(len(left)) + np.repeat(first - (after - counts), counts)


def planes(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, as how many bytes the largest needs, then all their lowest bytes, all the
    next ones, and so on: rows stay small in memory, and what repeats is compressed by the
    files and shuffles of Spark."""
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    parts = numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + parts.T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    made = np.zeros((parts.shape[1], 8), np.uint8)
    made[:, : len(parts)] = parts.T
    return made.view("<i8").ravel()


class Tokenizers:
    """Ids and bytes of pieces by both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as file:
            told = json.load(file)
        tokenizer = Tokenizer.from_file(path_a)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        # pieces that are one word are kept with their alignment, not here too
        self.encode_a = _library_encode(tokenizer, told, lowers=False, single=False)
        letters = byte_letters()
        self.bytes_a: list[bytes] = [b""] * tokenizer.get_vocab_size()
        for token, i in tokenizer.get_vocab().items():
            known = all(c in letters for c in token)
            self.bytes_a[i] = bytes(letters[c] for c in token) if known else token.encode()

        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b: list[bytes] = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode_b(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces; the model puts a space before each, which stands in those that start
        with one, and is taken off again from the others."""
        found = self.model.encode([p[1:] if p.startswith(" ") else p for p in pieces], num_threads=1)
        return [ids if p.startswith(" ") else ids[1:] for p, ids in zip(pieces, found, strict=True)]


class Aligned:
    """Groups and links of pieces that were met, remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.tokenizers = Tokenizers(path_a, path_b)
        self.size_a = np.array(list(map(len, self.tokenizers.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.tokenizers.bytes_b)), np.int64)
        self.name_a, self.name_b = ([str(i) for i in range(len(s))] for s in (self.size_a, self.size_b))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str | None] = []  # groups as text; None for a piece that is not given back
        self.counts = np.zeros((1 << 12, 4), np.int64)  # tokens of A and B, groups, links
        self.pairs = np.zeros(1 << 14, np.int64)
        self.at = np.zeros(1 << 12, np.int64)
        self.met = np.zeros(1 << 12, np.int64)
        self.used = 0

    def shrink(self, share: int = 2) -> None:
        """Keep that part of the bounds that was met most, of what was met again since the last time."""
        met = self.met[: len(self.texts)]
        kept = np.argsort(-met, kind="stable")[: MOST_PIECES // share]
        kept = np.sort(kept[met[kept] > 1])
        if self.counts[kept, 3].sum() > MOST_LINKS // share:
            kept = kept[:0]
        pieces = list(self.known)  # in the order of their numbers
        pieces, texts = [pieces[i] for i in kept.tolist()], [self.texts[i] for i in kept.tolist()]
        counts, pairs = self.counts[kept], self.links(kept)
        self.clear()
        self._keep(pieces, texts, counts, pairs)

    def rest(self) -> None:
        """At the end of a task: a worker that waits holds the pieces met most, and gives the
        other memory back."""
        if len(self.known) > MOST_PIECES // RESTING or self.used > MOST_LINKS // RESTING:
            self.shrink(RESTING)
        release_memory()

    def numbers(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        for i in range(0, len(new), LEARNED_AT_ONCE):
            self.learn(new[i : i + LEARNED_AT_ONCE])
        made = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        self.met[: len(known)] += np.bincount(made, minlength=len(known))
        return made

    def learn(self, pieces: list[str]) -> None:
        told = self.tokenizers
        ids_a, ids_b = told.encode_a(pieces), told.encode_b(pieces)
        bytes_a, bytes_b = told.bytes_a, told.bytes_b
        whole = []
        for p, a, b in zip(pieces, ids_a, ids_b, strict=True):
            own = p.encode()
            whole.append(b"".join([bytes_a[i] for i in a]) == own == b"".join([bytes_b[i] for i in b]))
        good_a = [a if w else [] for a, w in zip(ids_a, whole, strict=True)]
        good_b = [b if w else [] for b, w in zip(ids_b, whole, strict=True)]
        n_a, n_b = (np.fromiter(map(len, g), np.int64, len(pieces)) for g in (good_a, good_b))
        a, b = (np.fromiter(chain.from_iterable(g), np.int64, int(n.sum())) for g, n in ((good_a, n_a), (good_b, n_b)))
        counts = np.zeros((len(pieces), 4), np.int64)
        counts[:, 0], counts[:, 1] = n_a, n_b
        texts: list[str | None] = [None] * len(pieces)
        pairs = np.zeros(0, np.int64)
        if len(a):
            # the pieces in a row are one text: where one ends, both sides end
            ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
            group = group_ends(ends_a, ends_b)
            left, right = links_of(ends_a, ends_b)
            pairs = a[left] * PAIR + b[right]
            piece_a = np.repeat(np.arange(len(pieces)), n_a)
            last_a = np.append(np.flatnonzero(np.diff(group[: len(a)])), len(a) - 1)
            last_b = np.append(np.flatnonzero(np.diff(group[len(a) :])), len(b) - 1)
            counts[:, 2] = np.bincount(piece_a[last_a], minlength=len(pieces))
            counts[:, 3] = np.bincount(piece_a[left], minlength=len(pieces))
            texts = self._written(a, b, last_a, last_b, counts[:, 2])
        self._keep(pieces, [t if w else None for t, w in zip(texts, whole, strict=True)], counts, pairs)

    def _written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, groups: np.ndarray) -> list[str]:
        a, b = ([names[i] for i in ids.tolist()] for names, ids in ((self.name_a, a), (self.name_b, b)))
        made, at_a, at_b = [], 0, 0
        for end_a, end_b in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            made.append(f"{','.join(a[at_a:end_a])}|{','.join(b[at_b:end_b])}")
            at_a, at_b = end_a, end_b
        ends = np.cumsum(groups).tolist()
        return [made[end - 1] if n == 1 else ";".join(made[end - n : end]) for end, n in zip(ends, groups.tolist(), strict=True)]

    def _keep(self, pieces: list[str], texts: list[str | None], counts: np.ndarray, pairs: np.ndarray) -> None:
        first = len(self.texts)
        while first + len(pieces) > len(self.at):
            self.at, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.met))
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        while self.used + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.pairs[self.used : self.used + len(pairs)] = pairs
        links = counts[:, 3]
        self.at[first : first + len(pieces)] = self.used + np.cumsum(links) - links
        self.counts[first : first + len(pieces)] = counts
        self.used += len(pairs)
        self.texts += texts
        self.known.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def links(self, numbers: np.ndarray) -> np.ndarray:
        """The pairs of the given pieces in a row."""
        sizes = self.counts[numbers, 3]
        ends = np.cumsum(sizes)
        return self.pairs[np.repeat(self.at[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def batch(self, texts: list[str | None]) -> dict:
        """What a batch of texts holds, as one row: for each text its counts and digest, its
        distinct pieces and how often it has them; for each piece its pairs; the pairs."""
        if len(self.known) > MOST_PIECES or self.used > MOST_LINKS:
            self.shrink()
        pieces: list[str] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                own = CUT.split(" " + text)
                pieces += own
                sizes[i] = len(own)
        numbers = self.numbers(pieces)
        ends = np.cumsum(sizes)
        known, digests, parts = self.texts, [], []
        for i, (start, end) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
            own = numbers[start:end]
            written = [known[x] for x in own.tolist()]
            if None in written:
                # a text is what it is as a whole
                own = self.numbers([" " + texts[i]])
                written = [known[own[0]]]
                if written[0] is None:
                    own, written = own[:0], []
            parts.append(own)
            digests.append(hashlib.sha256(";".join(written).encode()).hexdigest() if written else "")
        numbers = np.concatenate([np.zeros(0, np.int64), *parts])
        owner = np.repeat(np.arange(len(texts)), list(map(len, parts)))
        counts = np.stack([np.bincount(owner, self.counts[numbers, k], len(texts)).astype(np.int64) for k in range(4)])
        distinct, local = np.unique(numbers, return_inverse=True)
        cells, often = np.unique(owner * max(1, len(distinct)) + local, return_counts=True)
        pairs, place = np.unique(self.links(distinct), return_inverse=True)
        met = np.bincount(np.repeat(np.arange(len(distinct)), self.counts[distinct, 3]), minlength=len(distinct))
        times = np.bincount(local, minlength=len(distinct))
        links = np.bincount(place, np.repeat(times, met), minlength=len(pairs)).astype(np.int64)
        return {
            "counts": counts, "digests": digests, "cells": np.diff(cells, prepend=0),
            "often": often, "met": met, "place": place, "pairs": pairs, "links": links,
        }


def aligned(path_a: str, path_b: str) -> Aligned:
    """The one of this Python worker."""
    return held_by_worker(("aligned", path_a, path_b), lambda: Aligned(path_a, path_b))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def batches_of(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each batch of texts: (batch, doc_ids, counts, digests; cells, often: the
    distinct pieces of each text, ascending, as steps, and how often it has them; met, place: the pairs of each
    piece; pairs, links: the distinct pairs and how many links have them)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = ["cells", "often", "met", "place"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligned(path_a, path_b)
        for batch in batches:
            for first, group in groups_of_column(batch.column(1), BATCH_CHARS):
                made = tool.batch(group)
                ids = pa.ListArray.from_arrays(pa.array([0, len(group)], pa.int32()), batch.column(0).slice(first, len(group)))
                columns = [pa.array([secrets.randbits(63)], pa.int64()), ids]
                columns += [pa.array([c.tolist()], pa.list_(pa.int64())) for c in made["counts"]]
                columns += [pa.array([made["digests"]], pa.list_(pa.string()))]
                columns += [pa.array([planes(made[p])], pa.binary()) for p in packed]
                columns += [pa.array([made[p]], pa.list_(pa.int64())) for p in ("pairs", "links")]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        tool.rest()

    names = ["batch", "doc_ids", *COUNTS, "digests", *packed, "pairs", "links"]
    schema = f"batch long, doc_ids array<{kind}>, {', '.join(f'{c} array<long>' for c in COUNTS)}, digests array<string>, "
    schema += ", ".join(f"{p} binary" for p in packed) + ", pairs array<long>, links array<long>"
    return docs.select("doc_id", "text").mapInArrow(make, schema)


def pair_counts(batches: DataFrame) -> DataFrame:
    """(pair, count, best): the links of each pair of ids in all texts, and whether no pair with
    the same id of B has more."""
    each = batches.select(F.explode(F.arrays_zip("pairs", "links")).alias("one"))
    counts = stored(each.groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.links").alias("count")), "pair_counts")
    id_b = (F.col("pair") % PAIR).alias("id_b")
    highest = counts.groupBy(id_b).agg(F.max("count").alias("highest"))
    return counts.withColumn("id_b", id_b).join(highest, "id_b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    n_best counts the links whose pair no other pair with the same id of B exceeds in all
    texts; count_sum adds the counts of all links.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    batches = stored(batches_of(docs, path_a, path_b), "aligned")
    counts = stored(pair_counts(batches), "counted")
    asked = batches.select("batch", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
    # a batch asks for its own distinct pairs only
    answers = asked.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("answers"))

    def finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                own = [batch.column(c)[i].values for c in range(1, 6)]
                cells, often, met, place = (from_planes(batch.column(c)[i].as_py()) for c in range(6, 10))
                told = batch.column(10)[i]
                text, held = np.divmod(np.cumsum(cells), max(1, len(met)))
                sums = []
                for name in ("best", "count"):
                    total = np.zeros(len(ids), np.int64)
                    if len(held):
                        values = np.asarray(told.values.field(name).to_numpy(zero_copy_only=False), np.int64)[place]
                        before, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(met)
                        by_piece = before[ends] - before[ends - met]
                        np.add.at(total, text, by_piece[held] * often)
                    sums.append(total)
                columns = [ids, *own[:4], *[pa.array(s, pa.int64()) for s in sums], own[4]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])

    told = batches.drop("pairs", "links").join(answers, "batch", "left").drop("batch")
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, n_best long, count_sum long, groups_sha256 string"
    return told.mapInArrow(finish, schema)
