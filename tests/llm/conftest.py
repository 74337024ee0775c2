import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Makes a documents table from texts; ids count from 1 unless given."""

    def make(texts, ids=None):
        rows = [
            (i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids or range(1, len(texts) + 1), texts)
        ]
        return spark.createDataFrame(rows, DOCS)

    return make
