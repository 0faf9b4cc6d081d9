from __future__ import annotations

import pytest

from tillwright.llm.common import prepare_workers

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Factory of documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""
    prepare_workers(spark)

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
