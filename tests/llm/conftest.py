import pytest


@pytest.fixture
def documents(spark):
    """A frame of documents from ``(doc_id, text)`` pairs, with columns whose names could clash."""

    def made(*pairs, sources=None):
        rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or ""), "x", 0) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, block int"
        )

    return made
