from __future__ import annotations

import pytest

from rostrum.llm.common import ship


@pytest.fixture(scope="session")
def session(spark):
    """The session, with the package given to the Python workers."""
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(session):
    """Documents with nulls, empty and long texts, repeated rows, ties, and columns whose names clash."""
    long = "Word salad, again and again. " * 20000
    rows = [(1, "The cat sat on the mat.", "en", 0.5), (2, "The cat sat on the mat.", None, None), (2, "The cat sat on the mat.", None, None),
            (3, None, "en", 1.0), (4, "", "de", None), (None, "no id", "en", 0.1), (None, None, None, None), (5, long, "en", 0.2),
            (6, "x", "fr", None), (7, " \n\t ", "en", None), (8, "日本語のテキスト", None, None), (9, "x" * 5000, None, 0.0)]
    return session.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
