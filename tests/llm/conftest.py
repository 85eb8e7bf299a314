import pytest

from sifter.session import local_session

#: Rows that every operator on documents must take: nulls, empty and white texts, repeated rows, a
#: long text, and columns whose names clash with those used inside.
EXTRA = "doc_id long, text string, source string, size long, k long, fp string, score double, row string"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, shuffle_partitions=4, app="sifter-tests")


@pytest.fixture(scope="session")
def odd(spark):
    long = " ".join(f"word{i % 977}x" for i in range(30_000))
    texts = [
        (0, "the same text here, five words. And more of it."), (1, "the same text here, five words. And more of it."),
        (2, None), (3, ""), (4, " \t\n "), (5, long), (6, long + " end"), (None, "no id at all in this row"),
        (None, None), (7, "é ünï 漢字 <|endoftext|> 's"), (8, "a\n\nb  c\r\nd"), (9, "one two"), (10, "one two"),
        (10, "one two"), (11, "One two"), (12, "x" * 5000),
    ]
    rows = [(i, t, [None, "b", "a", ""][n % 4], 1, 2, "f", 0.5, "r") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], EXTRA)
