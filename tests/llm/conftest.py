"""Fixtures shared by the corpus operator tests."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns."""
    def make(pairs):
        rows = [(i, t, None, f"src{k % 3}", None if t is None else len(t))
                for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, SCHEMA).selectExpr(
            "*", "1 as key", "'x' as name", "2 as pos", "3 as count",
            "array(1) as names", "'y' as value", "0 as row_no")
    return make


EDGE = [(1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (None, "a"),
        (5, "b" * 30000), (6, "b" * 30000), (7, "b" * 29999 + "c"),
        (8, " \n "), (9, "ä€😀" * 700), (10, "ä€😀" * 700)]
