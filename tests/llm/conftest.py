from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from llm_support import SF  # noqa: E402

from carelake.llm.shipping import ship  # noqa: E402
from carelake.plans.session import discard_written, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    ship(session)
    yield session
    discard_written(session)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, repeated rows and ids, a very long text, and columns named like the operators' own."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "the cat sat on the mat", "en", "a", 1, "x"), (1, "the cat sat on the mat", "en", "a", 1, "x"),
        (1, "another text of the same id", "en", "a", 1, "x"), (2, None, None, None, 2, "y"), (3, "", "en", "b", 3, None),
        (4, " \n\t ", "de", "b", 4, "z"), (5, long, "en", "a", 5, "x"), (6, long + " end", "en", "a", 6, "x"),
        (None, "no id here", "fr", "c", 7, "x"), (None, None, None, None, 8, None), (7, "12345 67890 !!", "fr", "c", 9, "x"),
        (8, "ß É ñ 漢字 – “quotes”", "de", None, 10, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size int, text_key string"
    ).selectExpr("*", "1 AS n_words", "'k' AS key", "true AS kept", "0.5D AS score", "2 AS target", "3 AS rep")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
