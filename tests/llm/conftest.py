import pytest


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with a source column."""

    def make(rows, source="a"):
        rows = [(i, t, source) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id bigint, text string, source string")

    return make
