import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, label string, bits string, keep string, row string"


@pytest.fixture
def docs_of(spark):
    """A documents table with further columns whose names clash with internal ones."""

    def docs(texts, start=0):
        rows = [
            (i if i is not None else None, t, "en", "s", len(t) if t is not None else None, "x", "y", "z", "b", "k", "r")
            for i, t in (texts if texts and isinstance(texts[0], tuple) else enumerate(texts, start))
        ]
        return spark.createDataFrame(rows, DOCS)

    return docs


@pytest.fixture
def sample(spark):
    """The smallest given documents, whole."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
