import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, kept STRING, fingerprint INT, size STRING, bucket STRING"

LONG = "lorem ipsum dolor sit amet " * 8000


def plain_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing columns."""
    texts = [
        "The quick brown fox jumps over the lazy dog near the river bank today",
        "the QUICK brown fox jumps over the lazy dog near the river bank today",
        None, "", " \t\n", "one", "two words", "Ünïcode ÄÖ straße wörter und noch mehr", LONG, LONG.upper(), "a\x00b c d",
        "The quick brown fox jumps over the lazy dog near the river bank tonight",
    ]
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, None, "x", 7, None, "b") for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, "the quick brown fox", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(plain_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
