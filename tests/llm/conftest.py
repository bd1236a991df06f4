from __future__ import annotations

from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test data")
    return SF_DIR


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, and columns
    with names that operators use themselves."""
    prose = " ".join(f"word{i * i % 9973}" for i in range(60_000))
    rows = [
        (1, "One two three four five six.", "en", "a", 1),
        (1, "One two three four five six.", "en", "a", 1),
        (1, "Something else under the same number", "en", "b", 2),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, "no number here at all, only text", None, None, 5),
        (None, None, None, None, None),
        (4, " \t\n ", "de", "c", 3),
        (5, prose, "en", "a", len(prose)),
        (6, "123 456 !!", "fr", None, 9),
        (7, "é", "fr", "d", 1),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    extra = ("row", "key", "rank", "score", "bits", "row_key", "position", "round", "turn", "slot", "marks", "class", "licences")
    return frame.selectExpr("*", *(f"'x' AS `{name}`" for name in extra), "1 AS `odd name`").cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")
