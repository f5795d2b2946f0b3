import pytest


@pytest.fixture
def docs(spark):
    """Makes a documents table; extra columns have names that the operators use inside."""

    def make(rows):
        rows = [(i, t, "en", "src0", len(t or ""), 1, "x") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long, key string")

    return make
