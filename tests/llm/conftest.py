import pytest


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "a"), (1, "alpha beta gamma delta epsilon zeta", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (None, "ALPHA beta gamma delta epsilon zeta", "de", "a"), (5, "word " * 60_000, "en", "b"), (6, "123 ... 456", "de", None)]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, score string")
