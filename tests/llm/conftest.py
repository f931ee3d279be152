from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from skyledger.llm.shipping import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def messy(spark):
    """Missing values in every column, empty and long texts, ties, repeated rows, and columns whose names
    operators use themselves."""
    prose = "The quick brown fox jumps over the lazy dog while seven wise men watch the river run"
    rows = [
        (1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (2, prose, "en", "a", None), (2, "other text for the same id", "en", "a", 3),
        (None, prose, None, None, None), (None, None, None, None, None), (3, None, "en", "b", 0), (4, "", "en", "b", 0),
        (5, " \n\t\n ", "de", None, 0), (6, "word " * 30_000, "de", "c", 1), (7, "x" * 200_000, "de", "c", 1),
        (8, "\n".join(prose for _ in range(40)), "en", "a", 1), (9, "é ü ñ 漢字 🙂 naïve", "fr", "c", 1),
    ]
    extra = ("n_words", "size", "own", "row", "group", "salt", "key", "keys", "hash", "part", "value", "start", "spans", "h", "d", "target")
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in extra:
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
