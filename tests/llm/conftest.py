import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Builds a DataFrame from rows and a DDL schema."""
    from vela.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string"


@pytest.fixture()
def odd_docs(frame):
    """Nulls in every column, empty and long texts, repeated rows, columns that clash with results."""
    long = "word%d other thing. " * 20
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "a", 0, 1.0, "x"), (3, "   \n\t ", "en", "a", 5, 1.0, "x"),
            (4, "one two three", "en", None, 13, 1.0, "x"), (5, "".join(long % ((k,) * 20) for k in range(300)), "en", "a", 1, 1.0, "x"),
            (6, "same text here. " * 3, None, "b", 1, 1.0, "x"), (6, "same text here. " * 3, None, "b", 1, 1.0, "x"),
            (7, "123 456 !!", "fr", "b", 10, 1.0, "x"), (None, "no id at all but some words", "fr", "b", 10, 1.0, "x")]
    return frame(rows, DOCS)


@pytest.fixture()
def no_docs(frame):
    return frame([], DOCS)
