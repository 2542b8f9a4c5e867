import pytest
from llm_data import DOCS, row


@pytest.fixture
def docs(spark):
    """A function: (doc_id, text[, lang, source]) rows -> documents with clashing extra columns."""
    return lambda rows: spark.createDataFrame([row(*r) for r in rows], DOCS)
