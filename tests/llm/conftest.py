import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SF = "/root/testdata/sf0.001"
LONG = "word%d and so on, été 12 " * 1
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (None, "no id at all, but words"), (None, None),
    (6, "Mail a.b@c.de or 10.0.0.256 or 10.0.0.7, card 4111 1111 1111 1111, call +49 (30) 123-4567."),
    (7, "  two  spaces \n  and\x00 a NUL <|endoftext|> <|startoftext|> é İ Σς 中文  x y \x1cz"),
    (8, " ".join(f"w{i % 700}" for i in range(9000))), (9, "a" * 3000), (9, "a" * 3000), (10, "Same id, first text of two."),
    (10, "Same id, second text of two, a little longer than the first."), (11, "The end."),
]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def rows(spark):
    """doc_id and text of the smallest documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with the names operators use inside."""
    more = [(d, t, "x", 1, "y", 2, "z", 3, 4.0, "u") for d, t in ODD]
    return spark.createDataFrame(more, "doc_id long, text string, key string, bucket int, digest string, shard int, spans string, slot int, "
                                       "score double, `a.b` string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
