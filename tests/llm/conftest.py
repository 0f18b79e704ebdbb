import pytest

CASES = [
    (1, "Plain words of a first text, long enough to have five or more of them in a row.", "en", "s1"),
    (2, "Plain words of a first text, long enough to have five or more of them in a row.", "en", "s2"),
    (3, None, None, None),
    (4, "", "en", "s1"),
    (5, "   \n\t ", "de", None),
    (6, "word", "en", "s1"),
    (7, "wort " * 30_000, "de", "s2"),
    (8, "123 456 !!! ###", "en", "s1"),
    (8, "123 456 !!! ###", "en", "s1"),
    (9, "Mail me at a.b@example.com or call +1 (555) 123-4567 from 10.0.0.1 today, please do so.", "en", "s3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names operators use inside."""
    rows = [(*r, k, "x", 0.5, 1, "y") for k, r in enumerate(CASES)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, rank long, digest string, score double, key int, bucket string").repartition(3)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def no_id(spark):
    return spark.createDataFrame([(None, "a b c d e f", "en", "s"), (None, "a b c d e f", "en", "s"), (1, "a b c d e f", None, None), (None, None, None, None)], "doc_id long, text string, lang string, source string")
