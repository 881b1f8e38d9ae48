import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text) rows with nulls, empties, a long text, repeats and an extra column whose name an operator uses."""
    long = " ".join(f"word{k}" for k in range(6000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away today", "en", "a", 1),
        (2, "The quick brown fox jumps over the lazy dog and runs far away today", "en", "a", 2),
        (3, None, "en", "a", 3),
        (4, "", None, None, 4),
        (5, long, "en", "b", 5),
        (6, long + " and a new end", "en", "b", 6),
        (7, "12 34 !!", "xx", "b", 7),
        (8, " \n\t ", "xx", None, None),
        (None, "a row without an id", "en", "c", 9),
        (1, "The quick brown fox jumps over the lazy dog and runs far away today", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long").cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
