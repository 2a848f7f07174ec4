from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Build a frame of documents from (doc_id, text, lang, source) rows."""
    def build(rows, extra: bool = False):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        # columns with names that the operators use inside
        return frame.selectExpr("*", "doc_id AS size", "text AS class", "1 AS n", "source AS owner", "2 AS ranges") if extra else frame
    return build
