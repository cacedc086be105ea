import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, _row string, _digest string, score string, copies string"


def long_text(n: int, k: int = 0) -> str:
    return " ".join(f"w{(i * 7919 + k) % 5003}" for i in range(n))


EDGE_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n", "en", "a", 3),
    (4, long_text(30000), "en", "a", 1),
    (5, "same text here now", "en", "b", 1),
    (6, "same  text here\nnow ", "en", "b", 1),
    (7, "same text here now", "en", None, 1),
    (7, "same text here now", "en", None, 1),
    (None, "same text here now", "en", "b", 1),
    (None, "only null", "en", "b", 1),
    (8, "ÄÖÜ ß é     中文 🙂", "de", "c", 1),
    (9, "x", "en", "c", 1),
]


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "f", "r", "d", "s", "c") for r in EDGE_ROWS], SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
