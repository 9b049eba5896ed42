import hashlib
import random
import zlib

import pytest

from factpanel.llm import merkle


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return joined(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(own):
    made = [own]
    while len(own) > 1:
        own = [joined(*own[i : i + 3]) for i in range(0, len(own), 3)]
        made.append(own)
    return made


def siblings(tree, pos):
    for own in tree[:-1]:
        run = pos - pos % 3
        yield own[run:pos], own[pos + 1 : run + 3]
        pos //= 3


def brute(rows):
    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(by_source[s], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))) for s in sources}
    trees = {s: levels([leaf(r, r.text) for r in ordered[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    made = []
    for k, s in enumerate(sources):
        for pos, r in enumerate(ordered[s]):
            path = [*siblings(trees[s], pos), *siblings(top, k)]
            text = r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf(r, text)
            for before, after in path:
                h = joined(*before, h, *after)
            proof = joined(*[x for before, after in path for x in before + after])
            made.append((r.doc_id, trees[s][0][pos], trees[s][-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return sorted(made, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos string, hash string, root string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "g", "p", "h", "r") for r in rows], SCHEMA)


def manifest(docs):
    found = merkle.manifest(docs, merkle.without_line_ends(docs))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("tier", [5, 1])
def test_against_trees_in_python(spark, monkeypatch, tier):
    """Trees of 1, 3, 4, 28 and 300 leaves, nulls, repeated rows and ids, one hot source."""
    monkeypatch.setattr(merkle, "TIER", tier)
    rng = random.Random(tier)
    rows = []
    for source, n in ((None, 4), ("", 1), ("é", 28), ("z", 3), ("hot", 300)):
        ids = rng.sample(range(10_000), n)
        rows += [(i, rng.choice(["a\nb", "plain", "", None, "é\n"]), rng.choice(["en", None]), source, rng.choice([3, None])) for i in ids]
    rows += [rows[5], rows[5], (None, "x\ny", "en", "z", 1), (None, None, None, None, None), (rows[40][0], "other", "de", rows[40][3], 0)]
    rng.shuffle(rows)
    docs = docs_of(spark, rows).repartition(3)
    assert manifest(docs) == brute(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_one_source_and_sources_of_one(spark, n):
    for source in (lambda i: "s", lambda i: f"s{i}"):
        docs = docs_of(spark, [(i, "a\nb", "en", source(i), 3) for i in range(n)])
        assert manifest(docs) == brute(docs.collect())


def test_any_change_is_found(spark):
    docs = docs_of(spark, [(i, f"text {i}", "en", f"s{i % 3}", 6) for i in range(40)])
    assert all(r.verified for r in merkle.manifest(docs).collect())
    changed = merkle.manifest(docs, merkle.F.concat("text", merkle.F.lit(" "))).collect()
    assert len(changed) == 40 and not any(r.verified for r in changed)


def test_no_documents(spark):
    assert manifest(docs_of(spark, [])) == []
