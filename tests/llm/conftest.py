from __future__ import annotations

import pytest

from millrace.llm.common import tune_text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def text_spark(spark):
    return tune_text(spark)


@pytest.fixture
def documents(text_spark):
    """Documents from (doc_id, text, source) rows."""

    def make(rows):
        full = [(d, t, "en", s, len(t or "")) for d, t, s in rows]
        return text_spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
