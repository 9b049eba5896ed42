import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, digest string, row string, key1 string, score string"


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that are easy to get wrong."""
    rng = random.Random(5)
    parts = ["a", "B", " ", "\n", "'s", "1", ".", "  ", "\t", "é", "<|endoftext|>", "́", "Σ", "😀", "日本", "the", "\x1c", "\r\n"]
    made = ["", " ", "a  b", "aaaaaaa aaaa", "x \n\n y", " \n", "it's 'sx", "a <|endoftext|> b", None]
    made += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(200)]
    return [*made, "long text of words. " * 5000]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Odd texts with null ids, repeated rows and columns of clashing names."""
    rows = [(i, t, "en" if i % 2 else None, "s", "d", "r", "k", "x") for i, t in enumerate(odd_texts)]
    rows += [rows[3], rows[3], (None, "a  b", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
