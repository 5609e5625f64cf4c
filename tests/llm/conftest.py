import pytest


@pytest.fixture(scope="session")
def model():
    from sieveline.llm import pii

    return pii.trained()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a null key, and columns whose names clash."""
    long = "Stir the soup, then wait. " * 20000
    rows = [(1, None, "https://a.test/1", 1, "x"), (2, "", None, 2, "x"), (2, "", None, 2, "x"), (3, long, "https://www.a.test/3", 3, "y"), (None, "Null key <b>bold</b>", "not a url", 4, None), (5, "\n\n \t\n", "https://b.test:80/5", 5, "z"), (6, "x" * 300000, None, 6, "z")]
    return spark.createDataFrame(rows, "rec_no bigint, content string, url string, line_no int, kind string")
