import hashlib
from collections import Counter

import numpy as np
import pytest

import public_tokenizers
from factpanel.llm import alignment

PATHS = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")]


def brute(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def bytes_a(i):
        return bytes(letters[c] for c in tokenizer.id_to_token(i))

    def bytes_b(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(parts):
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        return list(zip(ends[:-1], ends[1:], strict=True))

    made, counts = [], Counter()
    for text in texts:
        a, b = (tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        parts = list(map(bytes_a, a)), list(map(bytes_b, b))
        if text and not b"".join(parts[0]) == (" " + text).encode() == b"".join(parts[1]):
            a, b, parts = [], [], ([], [])
        in_a, in_b = map(spans, parts)
        links, start = [], 0
        for x, (low, high) in zip(a, in_a, strict=True):
            while start < len(b) and in_b[start][1] <= low:
                start += 1
            j = start
            while j < len(b) and in_b[j][0] < high:
                links.append((x, b[j]))
                j += 1
        groups, before = [], 0
        for end in sorted({h for _, h in in_a} & {h for _, h in in_b}):
            sides = [[x for x, (_, h) in zip(ids, own, strict=True) if before < h <= end] for ids, own in ((a, in_a), (b, in_b))] if len(a) < 2000 else None
            groups.append("|".join(",".join(map(str, s)) for s in sides) if sides else "")
            before = end
        counts.update(links)
        made.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (*m[:3], len(m[3]), sum(counts[p] == highest[p[1]] for p in m[3]), sum(counts[p] for p in m[3]), m[4])
        for m in made
    ]


def found(docs):
    rows = alignment.alignment(docs, *PATHS)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("bounds", [(150_000, 2_000_000), (40, 300)])
def test_odd_texts(odd_docs, monkeypatch, bounds):
    """With a small memory and small batches as well. The digest of the long text is left out."""
    monkeypatch.setattr(alignment, "MOST_PIECES", bounds[0])
    monkeypatch.setattr(alignment, "BATCH_CHARS", bounds[1])
    rows = odd_docs.collect()
    expected = sorted(((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows]), strict=True)), key=str)
    got = found(odd_docs)
    long = [i for i, r in enumerate(expected) if r[1] > 2000]
    for i in long:
        assert got[i][:-1] == expected[i][:-1] and len(got[i][-1]) == 64
    assert len(long) == 1 and [g for i, g in enumerate(got) if i not in long] == [e for i, e in enumerate(expected) if i not in long]


def test_numbers_take_the_bytes_they_need():
    for numbers in ([], [0], [0, 255], [7, 256, 3], [1 << 40, 0, 5], [(1 << 63) - 1]):
        data = alignment.planes(np.array(numbers, np.int64))
        assert alignment.from_planes(data).tolist() == numbers
        assert len(data) == 1 + len(numbers) * max(1, -(-max(numbers, default=0).bit_length() // 8))


def test_a_worker_rests(odd_texts, monkeypatch):
    """Between tasks a worker holds few pieces, and batches stay as they are."""
    monkeypatch.setattr(alignment, "MOST_PIECES", 40)
    monkeypatch.setattr(alignment, "LEARNED_AT_ONCE", 7)
    tool, texts = alignment.Aligned(*PATHS), [t or "" for t in odd_texts]
    first = tool.batch(texts)
    tool.rest()
    assert 0 < len(tool.known) <= 40 // alignment.RESTING
    again = tool.batch(texts)
    assert first["digests"] == again["digests"] and (first["counts"] == again["counts"]).all()
    assert first["pairs"].tolist() == again["pairs"].tolist() and first["links"].tolist() == again["links"].tolist()


def test_text_that_is_not_given_back(spark):
    """The model's own sign for a space comes back as a space."""
    docs = spark.createDataFrame([(1, "a▁b c"), (2, "<|endoftext|> </s> <0x41>")], "doc_id long, text string")
    rows = {r[0]: r[1:] for r in found(docs)}
    assert rows[1] == (0, 0, 0, 0, 0, 0, "")
    assert [rows[2]] == brute(["<|endoftext|> </s> <0x41>"])


def test_empty(spark, no_docs):
    assert found(no_docs) == []
    docs = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert found(docs) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_groups_of_random_cuts():
    """Pointer jumping against the common ends, also for one group of many tokens."""
    rng = np.random.default_rng(3)
    for length in (1, 2, 50, 5000):
        for share in (0.05, 0.5, 0.95):
            a, b = (np.append(np.flatnonzero(rng.random(length - 1) < share) + 1, length) for _ in range(2))
            group = alignment.group_ends(a, b)
            common = np.intersect1d(a, b)
            for ends, own in ((a, group[: len(a)]), (b, group[len(a) :])):
                assert (b[own] == common[np.searchsorted(common, ends)]).all()
            left, right = alignment.links_of(a, b)
            starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
            overlap = (starts[0][:, None] < b) & (starts[1] < a[:, None]) if length <= 50 else None
            assert overlap is None or [tuple(p) for p in np.argwhere(overlap)] == list(zip(left, right, strict=True))
    zigzag = np.arange(2, 4002, 2), np.append(np.arange(1, 4000, 2), 4000)
    assert len(set(alignment.group_ends(*zigzag).tolist())) == 1
