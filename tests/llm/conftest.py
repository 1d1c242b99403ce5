import pytest


@pytest.fixture
def docs(spark):
    """``docs([(1, "text"), ...])`` as documents with the usual columns."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema)

    return make
