"""Language of documents and of spans in them.

A word is what white space separates. The script of its letters narrows the languages
that it can belong to: those which use the script in the training texts. A naive Bayes
model over hashed character n-grams scores the word for each of them, and Viterbi
decoding with a penalty for each switch of language labels the words of a document, so
that single odd words stay in their surroundings while longer passages in another
language become spans of their own. The document's language is the one that labels the
most letters; its score is their share of all letters of the document.

The model is trained on a bounded sample: about SAMPLE_DOCS labelled documents per
language, drawn by a hash of their content, for every label there is. The model has a row of
BUCKETS numbers per label; it comes to the driver and goes to the tasks. Everything else
covers all documents and whole texts.

Defined cases
- Null texts and texts without letters are `und` with score 0. Texts whose letters are all in
  scripts that no language of the training texts uses get the language with most letters
  there, with score 0.
- Documents without a label are never trained on, nor are documents with the crc32 of
  their id (as text) at remainder 2 of 4, which are marked as held out; a null id is not
  held out. Equal scores go to the language that comes first in the alphabet.
- Repeated rows each get a prediction. Other columns take no part. Without any labelled
  document every prediction is `und`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factpanel.llm.common import groups_of_texts, held_by_worker

SAMPLE_DOCS = 2000
BUCKETS, GRAMS = 1 << 14, (1, 2, 3, 4)
SMOOTHING = 0.5
#: A word can speak against a language by this much at most; a switch costs this much.
MOST_AGAINST, SWITCH = 8.0, 20.0
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.01
#: A document is accepted if this share of its letters is in its language.
ACCEPT_SHARE = 0.25
UNDETERMINED = "und"

# First and last code point of the letters of a script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = [*dict.fromkeys(name for name, _, _ in SCRIPTS), "other"]
_LETTERS = re.compile(r"[^\W\d_]+")
_ranges = sorted((first, last, SCRIPT_NAMES.index(name)) for name, first, last in SCRIPTS)
_FIRSTS, _LASTS, _NUMBERS = (np.array(x) for x in zip(*_ranges, strict=True))


def scripts_of(codes: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_FIRSTS, codes, side="right") - 1
    inside = (at >= 0) & (codes <= _LASTS[at])
    return np.where(inside, _NUMBERS[at], len(SCRIPT_NAMES) - 1)


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of all character n-grams of the words, with a mark at both ends."""
    marked = [f"\x02{w}\x03" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in marked])
    owners, buckets = [], []
    for n in GRAMS:
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        value = np.full(last, n, np.uint64)
        for i in range(n):
            value = value * np.uint64(0x100000001B3) ^ codes[i : i + last]
        value *= np.uint64(0x9E3779B97F4A7C15)
        whole = owner[:last] == owner[n - 1 :]
        owners.append(owner[:last][whole])
        buckets.append((value[whole] >> np.uint64(50)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def letters_of(word: str) -> str:
    return "".join(_LETTERS.findall(word)).lower()


class Model:
    """languages in alphabetical order, the log shares of buckets (buckets by languages),
    and which language uses which script (scripts by languages)."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        self.usual = int(scripts.sum(axis=0).argmax()) if languages else 0
        smooth = counts + SMOOTHING
        self.logs = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
        self.uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, letters): how much each word speaks against each language (0 for its best,
        MOST_AGAINST at most, all 0 if it has no candidate), and its number of letters, as a
        negative number if it has no candidate."""
        cleaned = list(map(letters_of, words))
        letters = np.fromiter(map(len, cleaned), np.int64, len(cleaned))
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        filled = np.flatnonzero(letters)
        if not len(filled):
            return scores, letters
        kept = [cleaned[i] for i in filled]
        owner, bucket = word_grams(kept)
        order = np.argsort(owner, kind="stable")
        sums = np.add.reduceat(self.logs[bucket[order]], np.searchsorted(owner[order], np.arange(len(kept))), axis=0)
        candidates = self.uses[scripts_of(np.array([ord(w[0]) for w in kept]))]
        sums = np.where(candidates, sums, -np.inf)
        known = candidates.any(axis=1)
        best = np.where(known, sums.max(axis=1), 0)
        against = np.minimum(best[:, None] - sums, MOST_AGAINST)
        scores[filled] = np.where(known[:, None], -against, 0)
        letters[filled[~known]] *= -1
        return scores, letters


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word: scores of all words in a row, sizes of the documents.
    One step handles the words at the same place of all documents that are long enough."""
    n_words, n_labels = scores.shape
    labels = np.zeros(n_words, np.int64)
    if not n_words or n_labels == 1:
        return labels
    order = np.argsort(-sizes, kind="stable")
    ordered = sizes[order]
    starts = (np.cumsum(sizes) - sizes)[order]
    active = np.searchsorted(-ordered, -np.arange(1, ordered[0] + 1), side="right")
    kind = np.min_scalar_type(n_labels - 1)
    back = np.zeros((n_words, n_labels), kind)
    own = np.arange(n_labels, dtype=kind)
    value = np.zeros((len(sizes), n_labels), np.float64)
    for t, n in enumerate(active.tolist()):
        at, now = starts[:n] + t, value[:n]
        if t:
            best = now.argmax(axis=1)
            moved = now[np.arange(n), best][:, None] - switch
            stays = now >= moved
            back[at] = np.where(stays, own, best[:, None].astype(kind))
            now = np.where(stays, now, moved)
        value[:n] = now + scores[at]
    label = value.argmax(axis=1)
    for t in range(int(ordered[0]) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = label[:n]
        if t:
            label[:n] = back[at, label[:n]]
    return labels


class Labeller:
    """Scores of words are kept, as most words come again."""

    MOST_WORDS, MOST_SCORES = 150_000, 1 << 24
    #: Characters of a group of texts, times languages (a longer text stands alone).
    GROUP_CHARS = 8_000_000

    def __init__(self, model: Model):
        self.model = model
        n = len(model.languages)
        self.most_words = min(self.MOST_WORDS, max(1, self.MOST_SCORES // n))
        self.group_chars = min(2_000_000, self.GROUP_CHARS // n)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1 << 14, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1 << 14, np.int64)

    def label(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(labels, letters, sizes): label and letters (see score_words) of all words in a row,
        and the number of words of each text."""
        if len(self.known) > self.most_words:
            self._clear()
        cut = [t.split() for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        words = [w for own in cut for w in own]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            scores, letters = self.model.score_words(new)
            have = len(self.known)
            while have + len(new) > len(self.letters):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
            self.scores[have : have + len(new)] = scores
            self.letters[have : have + len(new)] = letters
            self.known.update(zip(new, range(have, have + len(new)), strict=True))
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return viterbi(self.scores[numbers], sizes), self.letters[numbers], sizes


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text): about sample_docs documents of each language, by a hash of the content."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    whole = 1 << 30
    limits = {r["lang"]: int(min(1.0, sample_docs / r["n"]) * whole) for r in counts.collect()}
    if not limits:
        return labelled.select("lang", "text")
    shares = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(whole))
    return labelled.where(draw < shares[F.col("lang")]).select("lang", "text")


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Counts of n-grams and scripts per language. What comes to the driver has at most a row
    per language and bucket or script."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [w for w in map(letters_of, text.split()) if w]
                if not words:
                    continue
                own = total.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                own[:BUCKETS] += np.bincount(word_grams(words)[1], minlength=BUCKETS)
                codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
                own[BUCKETS:] += np.bincount(scripts_of(codes), minlength=len(SCRIPT_NAMES))
        for lang, own in total.items():
            at = np.flatnonzero(own)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "feature", "n"])

    counted = training_sample(docs, sample_docs).mapInArrow(count, "lang string, feature int, n long")
    rows = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)), np.float64)
    place = {lang: i for i, lang in enumerate(languages)}
    columns = [place[lang] for lang in rows.column("lang").to_pylist()]
    table[rows.column("feature").to_numpy(), np.array(columns, np.int64)] = rows.column("n").to_numpy()
    return Model(languages, table[:BUCKETS], table[BUCKETS:])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and spans (language, first word, number of words), all
    other columns as they are; spans of words without letters belong to their neighbours."""
    kind = "lang_pred string, score double, spans array<struct<lang: string, start: bigint, words: bigint>>"
    spans_kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("words", pa.int64())]))
    names, place, uuid = docs.columns, docs.columns.index("text"), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = held_by_worker(("labeller", uuid), lambda: Labeller(model)) if model.languages else None
        most = labeller.group_chars if labeller else 2_000_000
        for batch in batches:
            for first, group in groups_of_texts([t or "" for t in batch.column(place).to_pylist()], most):
                made = [(UNDETERMINED, 0.0, [])] * len(group) if labeller is None else _told(labeller, group)
                told, score, spans = zip(*made, strict=True)
                columns = [c.slice(first, len(group)) for c in batch.columns]
                columns += [pa.array(told, pa.string()), pa.array(score, pa.float64()), pa.array(spans, spans_kind)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score", "spans"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{own}, {kind}")


def _told(labeller: Labeller, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
    languages = labeller.model.languages
    labels, letters, sizes = labeller.label(texts)
    n = len(languages)
    doc = np.repeat(np.arange(len(texts)), sizes)
    votes = np.bincount(doc * n + labels, weights=np.maximum(letters, 0), minlength=len(texts) * n).reshape(len(texts), n)
    total, best = np.bincount(doc, weights=np.abs(letters), minlength=len(texts)), votes.argmax(axis=1)
    cuts = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
    ends = np.append(cuts[1:], len(labels))
    starts = np.cumsum(sizes) - sizes
    spans: list[list[dict]] = [[] for _ in texts]
    for a, b, d, label in zip(cuts.tolist(), ends.tolist(), doc[cuts].tolist(), labels[cuts].tolist(), strict=True):
        spans[d].append({"lang": languages[label], "start": a - int(starts[d]), "words": b - a})
    best = np.where(votes.any(axis=1), best, labeller.model.usual)
    return [
        (languages[best[i]], float(votes[i, best[i]] / total[i]), spans[i]) if total[i] else (UNDETERMINED, 0.0, [])
        for i in range(len(texts))
    ]


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans) of every document."""
    told = predict(docs.select("doc_id", "text"), train(docs, sample_docs))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def accepted(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The documents in a language that was learned, with all their columns: those with
    letters of which at least ACCEPT_SHARE are in one language. A share of 0 is never enough."""
    named = {c: f"_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    plain = docs.select("text", *[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    told = predict(plain, train(docs, sample_docs))
    kept = told.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= ACCEPT_SHARE))
    return kept.select(*["text" if c == "text" else F.col(named[c]).alias(c) for c in docs.columns])
