"""Ids of whole texts through a cache of their space-separated pieces.

Texts repeat their words, and a byte-level or word BPE never merges across a single
space or line end that stands between two other characters. So a text is cut there,
each distinct piece is encoded once in a task, and ids of texts are gathered from the
pieces by array arithmetic. Runs of white space stay inside a piece together with both
neighbours, so that the cut never changes the ids.
"""

from __future__ import annotations

import gc
import string
from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from factpanel.llm.common import held_by_worker, release_memory

Encode = Callable[[list[str]], list[list[int]]]

#: Bounds of the cache: pieces, and characters in them. Beyond, the half that was met most
#: since the last time stays.
MOST_PIECES, MOST_CHARS = 600_000, 24_000_000
#: Of these bounds, the share that is held between two tasks, where an operator asks for that.
RESTING = 8
#: New pieces that are encoded at once.
LEARNED_AT_ONCE = 50_000

# A key is a piece as split() leaves it: its space is taken off, a line end is not.
FIRST = " "  # before the piece that starts a text
WHOLE = "  "  # before a piece that is taken as it stands
UNSAFE = 0


def _literal(key: str) -> str | None:
    """What a key stands for, or None if white space touches white space, so that the cut
    may be wrong."""
    if key.startswith(FIRST):
        if key.startswith(WHOLE):
            return key[2:]
        return None if len(key) == 1 or key[-1].isspace() else key[1:]
    if not key or key[-1].isspace():
        return None
    if key[0] == "\n":
        return None if key[1].isspace() else key
    return None if key[0].isspace() else " " + key


def _joined(parts: list[str]) -> list[str]:
    """Keys of a text in which white space touches white space."""
    made: list[str] = [parts[0]]
    for part in parts[1:]:
        literal = part if part.startswith("\n") else " " + part
        last = made[-1]
        if last and not last[-1].isspace() and len(literal) > 1 and not literal[1].isspace():
            made.append(literal)
        else:
            made[-1] = last + literal
    return [WHOLE + literal for literal in made if literal]


SIGNS = string.punctuation
#: Of ASCII and Latin-1, without the letters ª, µ and º among the signs.
LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if chr(c) not in "×÷")


def _listed(keys: pa.Array) -> list[str]:
    return keys.to_numpy(zero_copy_only=False).tolist()


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pieces of a column, which one each piece of the texts in a row is, and how
    many pieces each text has: none if it is null or empty."""
    held = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
    counts = np.zeros(len(texts), np.int64)
    # a line end may become two characters, so 32-bit places may not do
    full = texts.filter(held).cast(pa.large_string())
    cut = pc.split_pattern(pc.replace_substring(full, "\n", " \n"), " ")
    counts[held.to_numpy(zero_copy_only=False)] = pc.list_value_length(cut).to_numpy()
    pieces = cut.flatten().dictionary_encode()
    return pieces.dictionary, pieces.indices.to_numpy(), counts


def _signs_after_word(keys: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(which, words, signs): the keys that are one word of letters and signs after it."""
    after = pc.utf8_ltrim(keys, LETTERS)
    size = pc.binary_length(after)
    which = pc.equal(pc.binary_length(pc.utf8_rtrim(after, SIGNS)), 0)
    which = pc.and_(which, pc.and_(pc.greater(size, 0), pc.less(size, pc.binary_length(keys))))
    which = pc.and_(which, pc.invert(pc.match_substring(after, "<|")))
    return which, pc.utf8_rtrim(keys.filter(which), SIGNS), after.filter(which)


class PieceCache:
    """encode: ids of each of the given texts, with what the tokenizer does to them."""

    def __init__(self, encode: Encode, prepare: Callable[[str], str] | None = None, signs_apart: bool = False):
        """signs_apart: signs after a letter are encoded as if they stood alone."""
        self.encode, self.prepare, self.signs_apart = encode, prepare, signs_apart
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(1 << 16, np.int32)
        self.at, self.size, self.met = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used, self.count = 0, 1

    def _shrink(self, share: int = 2) -> None:
        """Keep that part of the bounds that was met most, of the pieces met more than once."""
        pieces = [key for key, n in self.known.items() if n]  # in the order of their numbers
        met = self.met[1 : self.count]
        order = np.argsort(-met, kind="stable")
        order = order[: int((met > 1).sum())][: MOST_PIECES // share]
        chars = np.cumsum(np.fromiter((len(pieces[i]) for i in order.tolist()), np.int64, len(order)))
        numbers = np.concatenate([[0], np.sort(order[chars <= MOST_CHARS // share]) + 1])
        kept = [pieces[n - 1] for n in numbers[1:].tolist()]
        sizes = self.size[numbers]
        ends = np.cumsum(sizes)
        index = np.repeat(self.at[numbers] - (ends - sizes), sizes) + np.arange(ends[-1])
        self.used, self.count = len(index), len(numbers)
        self.ids[: self.used] = self.ids[index]
        self.at[: self.count], self.size[: self.count] = ends - sizes, sizes
        self.met[:] = 0
        self.known = {key: n for n, key in enumerate(kept, 1)}
        self.chars = sum(map(len, self.known))
        self.retained(numbers)

    def rest(self) -> None:
        """At the end of a task: a worker that waits, or runs a task without texts, holds the
        pieces met most and gives the other memory back."""
        if len(self.known) > MOST_PIECES // RESTING or self.chars > MOST_CHARS // RESTING:
            self._shrink(RESTING)
            self.ids = self.ids[: max(1 << 16, self.used)].copy()
            self.at, self.size, self.met = (x[: max(1 << 14, self.count)].copy() for x in (self.at, self.size, self.met))
        release_memory()

    def retained(self, numbers: np.ndarray) -> None:
        """For what a subclass keeps beside the ids: the pieces that stay."""

    def learned(self, found: list[list[int]]) -> None:
        """The same for new pieces."""

    def _learn(self, keys: list[str]) -> None:
        keys = list(dict.fromkeys(keys))
        for i in range(0, len(keys), LEARNED_AT_ONCE):
            self._learn_some(keys[i : i + LEARNED_AT_ONCE])

    def _learn_some(self, keys: list[str]) -> None:
        good, literals = [], []
        for key in keys:
            # most begin and end with other characters than white space
            literal = _literal(key) if not key or key[0].isspace() or key[-1].isspace() else " " + key
            if literal is None:
                self.known[key] = UNSAFE
            else:
                good.append(key)
                literals.append(literal)
        if not good:
            return
        found = self.encode(literals)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(good) > len(self.at):
            self.at, self.size, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size, self.met))
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
        self.at[self.count : self.count + len(good)] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count : self.count + len(good)] = sizes
        self.known.update(zip(good, range(self.count, self.count + len(good)), strict=True))
        self.chars += sum(map(len, good))
        self.used, self.count = self.used + total, self.count + len(good)
        self.learned(found)

    def _numbers(self, keys: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        where = np.flatnonzero(numbers < 0)
        if len(where):
            missing = [keys[i] for i in where.tolist()]
            self._learn(missing)
            numbers[where] = np.fromiter(map(self.known.__getitem__, missing), np.int64, len(missing))
        return numbers

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts in a row, and how many each text has."""
        collects = gc.isenabled()
        gc.disable()  # many small lists arise here, none of them in a cycle
        try:
            return self._numbers_of(texts)
        finally:
            if collects:
                gc.enable()

    def _numbers_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > MOST_PIECES or self.chars > MOST_CHARS:
            self._shrink()
        if self.prepare:
            texts = list(map(self.prepare, texts))
        keys: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                parts = text.replace("\n", " \n").split(" ")
                parts[0] = FIRST + parts[0]
                keys += parts
                counts[i] = len(parts)
        return self._safe(self._numbers(keys), counts, texts.__getitem__)

    def _safe(self, numbers: np.ndarray, counts: np.ndarray, text_at: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
        """numbers and counts, with texts in which the cut may be wrong cut anew."""
        self.met[: self.count] += np.bincount(numbers, minlength=self.count)
        if (numbers != UNSAFE).all():
            return numbers, counts
        starts = np.cumsum(counts) - counts
        cut: list[np.ndarray] = []
        for i in range(len(counts)):
            own = numbers[starts[i] : starts[i] + counts[i]]
            if (own == UNSAFE).any():
                text = text_at(i)
                joined = _joined(text.replace("\n", " \n").split(" ")) if " \n" not in text else [WHOLE + text]
                own = self._numbers(joined)
                counts[i] = len(own)
            cut.append(own)
        return np.concatenate(cut), counts

    def numbers_of_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for an Arrow column, nulls as empty texts. Arrow cuts the texts and finds
        the distinct pieces; only these become Python texts."""
        if self.prepare:
            return self.numbers([t or "" for t in texts.to_pylist()])
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._numbers_of_column(texts)
        finally:
            if collects:
                gc.enable()

    def _numbers_of_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > MOST_PIECES or self.chars > MOST_CHARS:
            self._shrink()
        keys, index, counts = _cut(texts)
        if not len(index):
            return np.zeros(0, np.int64), counts
        starts = (np.cumsum(counts) - counts)[counts > 0]
        first = index[starts]
        firsts = [FIRST + key for key in _listed(keys.take(pa.array(first)))]
        later = np.bincount(index, minlength=len(keys)) > np.bincount(first, minlength=len(keys))
        number, signs = self._numbers_of_keys(keys, later)
        del keys
        numbers = number[index]
        numbers[starts] = self._numbers(firsts)
        if signs is not None:
            second = signs[index]
            second[starts] = -1
            both = second >= 0
            ends = np.cumsum(both)
            text_ends = np.concatenate([[0], ends])[np.cumsum(counts)]
            counts += np.diff(text_ends, prepend=0)
            numbers = np.repeat(numbers, 1 + both)
            where = np.flatnonzero(both)
            numbers[where + ends[where]] = second[where]
        return self._safe(numbers, counts, lambda i: texts[i].as_py())

    def _numbers_of_keys(self, keys: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Numbers of the wanted keys, and of the signs after them where these are a piece of
        their own, else -1; None if no key is cut."""
        number, signs = np.zeros(len(keys), np.int64), None
        where = np.flatnonzero(wanted)
        keys = keys.filter(pa.array(wanted))
        if self.signs_apart:
            which, words, after = _signs_after_word(keys)
            both = which.to_numpy(zero_copy_only=False)
            after = after.dictionary_encode()
            signs = np.full(len(number), -1, np.int64)
            own = np.array(self._numbers([WHOLE + key for key in _listed(after.dictionary)]), np.int64)
            signs[where[both]] = own[after.indices.to_numpy()]
            keys = pa.concat_arrays([keys.filter(pc.invert(which)), words]).dictionary_encode()
            where = np.concatenate([where[~both], where[both]])
            number[where] = self._numbers(_listed(keys.dictionary))[keys.indices.to_numpy()]
        else:
            number[where] = self._numbers(_listed(keys))
        return number, signs

    def gather(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        return self.gather_numbers(*self.numbers(texts))

    def gather_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for an Arrow column, nulls as empty texts."""
        return self.gather_numbers(*self.numbers_of_column(texts))

    def gather_numbers(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[numbers]
        ends = np.cumsum(sizes)
        index = np.repeat(self.at[numbers] - (ends - sizes), sizes)
        index += np.arange(len(index))
        text_ends = np.concatenate([[0], ends])[np.cumsum(counts)]
        return self.ids[index], np.diff(text_ends, prepend=0)


#: Fixed value: the words of a byte-level pre-tokenizer that has no pattern of its own.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that are kept besides, of pieces that hold more than one.
MOST_WORDS = 100_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes are
    themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in set(printable))
    letters.update({chr(256 + i): b for i, b in enumerate(others)})
    return letters


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _words_pattern(told: dict) -> str | None:
    """The pattern of words, if the file's steps are known: byte-level, or a split by one
    pattern and then byte-level."""
    steps = told["pre_tokenizer"].get("pretokenizers", [told["pre_tokenizer"]])
    if [s["type"] for s in steps] == ["ByteLevel"] and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]:
        return BYTE_LEVEL_WORDS
    if [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"]:
        split = steps[0]
        if split["behavior"] == "Removed" and split["invert"]:
            return split["pattern"].get("Regex")
    return None


def _library_encode(tokenizer, told: dict, lowers: bool, single: bool = True) -> Encode:
    """Encode many short texts. Words of Latin-1 texts, which no normaliser of the known
    files changes once they are in lower case, go to the library's model directly and
    are kept (`single`: also of texts that are one word, which a PieceCache keeps itself); all
    other texts take the whole way through the library."""
    import regex

    model = tokenizer.model
    pattern = _words_pattern(told)
    plain = all(s["type"] in ("NFC", "Replace", "Lowercase") for s in (told["normalizer"] or {}).get("normalizers", []))
    words = regex.compile(pattern) if pattern and plain else None
    letter_of = {b: letter for letter, b in byte_letters().items()}
    letters = {c: "".join(letter_of[b] for b in chr(c).encode()) for c in range(256)}
    space = letter_of[32]
    spaced = pattern == BYTE_LEVEL_WORDS  # the space before a word is a part of it
    direct = words is not None and spaced and not lowers and not single
    known: dict[str, tuple[int, ...]] = {}
    tokenize = model.tokenize

    def of_word(word: str) -> tuple[int, ...]:
        if word.isascii() and word.isprintable():
            spelled = word.replace(" ", space)
        else:
            spelled = word.translate(letters)
        return tuple([t.id for t in tokenize(spelled)])

    def kept(word: str) -> tuple[int, ...]:
        if len(known) > MOST_WORDS:
            known.clear()
        known[word] = ids = of_word(word)
        return ids

    def encode(texts: list[str]) -> list[list[int]]:
        found: list[list[int] | None] = []
        others = []
        for text in texts:
            if direct and text.isascii() and text[:1] == " " and (bare := text[1:]).isalpha():  # most pieces are one word
                found.append(known.get(text) or [t.id for t in tokenize(space + bare)])
                continue
            if words is None or "<|" in text or not _is_latin(text) or (lowers and text != text.lower()):
                others.append(len(found))
                found.append(None)
                continue
            bare = text[1:] if text.startswith(" ") else text
            if bare.isalpha():
                word = text if spaced else bare
                found.append(known.get(word) or (kept if single else of_word)(word))
                continue
            if spaced and bare is not text:  # most others are one word and signs after it
                word = text.rstrip(SIGNS)
                if word[1:].isalpha():
                    signs = text[len(word) :]
                    found.append((known.get(word) or kept(word)) + (known.get(signs) or kept(signs)))
                    continue
            own: list[int] = []
            for word in words.findall(text):
                own += known.get(word) or kept(word)
            found.append(own)
        if others:
            for i, e in zip(others, tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False), strict=True):
                found[i] = e.ids
        return found

    return encode


def latin_lower(text: str) -> str:
    """text in lower case with spaces for line ends, if that cannot change what a
    lower-casing tokenizer that drops white space makes of it; else text."""
    if "<|" in text:
        return text
    return text.replace("\n", " ").lower() if _is_latin(text) else text


def library_cache(path: str) -> PieceCache:
    """A cache over the tokenizers library's file at `path`, without special tokens added,
    truncation or padding. Special tokens written in a text are found, as by default."""
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    steps = (told["normalizer"] or {}).get("normalizers", [])
    lowers = any(step["type"] == "Lowercase" for step in steps)
    encode = _library_encode(tokenizer, told, lowers, single=False)
    signs_apart = told["normalizer"] is None and _words_pattern(told) == BYTE_LEVEL_WORDS
    return PieceCache(encode, latin_lower if lowers else None, signs_apart)


def cache_of(path: str) -> PieceCache:
    """The cache of this Python worker."""
    return held_by_worker(("pieces", path), lambda: library_cache(path))
