"""Small tables for the text operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """Makes a documents table from (doc_id, text) pairs or (doc_id, text, lang)."""

    def make(rows, extra: str = ""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        if extra:
            return spark.createDataFrame([(*r, 1) for r in full], f"{DOCS}, {extra} int").repartition(3)
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make
