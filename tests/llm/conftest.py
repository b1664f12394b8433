import pytest

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples."""

    def build(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
