from __future__ import annotations

import pytest


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(*r, *(None, None)[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        full = [(*r[:4], None if r[1] is None else len(r[1])) for r in full]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
