import os

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
EXTRA = ["size", "kept", "score", "h", "id", "component_id", "_copies", "lang_pred", "sid", "spans", "chunk", "n"]


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty, blank, very long and repeated texts, ties, repeated rows and clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from it all "
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", None, None),
        (3, " \t\n", None, "a", 3),
        (4, "Straße ☃ " + prose * 3, "de", "b", 9),
        (5, prose * 20_000, "en", "b", 9),
        (6, prose * 8, None, "c", 9),
        (7, prose * 8, "en", "c", 9),
        (8, "x", "en", None, 1),
        (8, "x", "en", None, 1),
        (None, prose * 8, "en", "a", 9),
        (9, "1234 5678 --", "en", "d", 9),
    ]
    df = spark.createDataFrame(rows, DOC)
    return df.selectExpr("*", *[f"doc_id AS {c}" for c in EXTRA])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)
