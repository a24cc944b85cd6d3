import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A table with the columns of documents from texts, or from (id, text) pairs."""

    def make(rows):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs], SCHEMA)

    return make
