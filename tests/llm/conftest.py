import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text) pairs; other columns are filled in."""

    def make(rows, lang="en", source="src1"):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make
