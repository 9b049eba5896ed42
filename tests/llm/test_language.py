import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factpanel.llm import language

WORDS = {
    "en": "the of and house with rather long english words thinking about weather".split(),
    "fr": "le la les des maison avec plutôt longue français être où déjà".split(),
    "ru": "это дом и погода с длинными русскими словами думать".split(),
}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = [
        (i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 60))), lang, "x", "y")
        for i, lang in enumerate(itertools.islice(itertools.cycle(WORDS), 300))
    ]
    rows += [(1000, None, "en", "", ""), (1001, "", None, "", ""), (1002, "12 34 ...", None, "", ""), (1003, "日本 語", None, "", "")]
    rows += [rows[0], (None, "the house and the weather", None, "", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, held_out string").cache()


def test_held_out_documents_are_told(docs):
    import zlib

    found = language.identify(docs).collect()
    assert len(found) == docs.count()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif r.doc_id == 1003:  # letters, in scripts that no language uses
            assert r.lang_pred in WORDS and r.score == 0
        elif r.doc_id is not None:
            assert r.lang_pred == truth[r.doc_id]


def test_held_out_documents_are_not_learned(docs):
    sample = language.training_sample(docs)
    held = docs.where(language.held_out(F.col("doc_id"))).select("text")
    assert sample.join(held, "text", "left_semi").isEmpty()


def test_spans_of_mixed_text(spark, docs):
    model = language.train(docs)
    text = " ".join(WORDS["en"] * 3 + WORDS["fr"] * 3 + WORDS["ru"] * 3)
    (row,) = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [s.lang for s in row.spans] == ["en", "fr", "ru"]
    assert sum(s.words for s in row.spans) == len(text.split())


def test_letters_of_unknown_scripts_count(spark, docs):
    text = "λόγος " * 200 + "the"
    made = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), language.train(docs))
    (row,) = made.collect()
    assert row.lang_pred == "en" and row.score == pytest.approx(3 / 1003)


@pytest.mark.parametrize("n_labels", [70, 300])
def test_every_label_is_learned(spark, n_labels):
    def words(i):
        rng = random.Random(i)
        return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]

    rows = [(10 * i + j, " ".join(random.Random(j).choices(words(i), k=40)), f"l{i:03}") for i in range(n_labels) for j in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    wrong = [i for i, _, lang in rows if told[i] != lang]
    assert set(told.values()) == {lang for _, _, lang in rows} and not wrong


def test_a_very_long_text(spark, docs):
    text = " ".join(WORDS["fr"] * 20_000)
    (row,) = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), language.train(docs)).collect()
    assert (row.lang_pred, row.score) == ("fr", 1) and sum(s.words for s in row.spans) == len(text.split())


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    sizes = np.array([0, 1, 5, 3, 6, 0])
    scores = rng.normal(size=(sizes.sum(), 3)) * 3
    labels, at = language.viterbi(scores, sizes, 2.0), 0

    def worth(own, path):
        return sum(own[i][x] for i, x in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))

    for n in sizes:
        own, path = scores[at : at + n], tuple(labels[at : at + n])
        best = max(worth(own, p) for p in itertools.product(range(3), repeat=int(n)))
        assert worth(own, path) == pytest.approx(best)
        at += n


def test_accuracy_on_driver_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = language.identify(documents).where("held_out").join(documents.select("doc_id", "lang"), "doc_id")
    right, n = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("lang")).first()
    assert n > 200 and right > 0.98


def test_rejected_documents_go(docs):
    kept = language.accepted(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {1000, 1001, 1002, 1003}


def test_nothing_to_learn(spark, no_docs):
    assert language.identify(no_docs).collect() == []
    (row,) = language.identify(spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")).collect()
    assert (row.lang_pred, row.score) == ("und", 0)
