import pytest

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(9000))
PASSAGE = "A passage of some length that stands in more than one text, word for word, and so has to be found again. " * 3
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, ids string, "
    "spans string, doc long, row string, bucket long, decoded string, grade string, words string, w string, label string"
)


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and extra columns with the names of outputs."""
    texts = [
        (1, "Short text."), (2, None), (3, ""), (None, "a text without any id at all"), (5, LONG), (6, LONG),
        (7, "x" * 5000), (8, "one two three four five six"), (8, "one two three four five six"), (9, "  \n\t "),
        (10, "Before. " + PASSAGE + " After é漢😀."), (11, PASSAGE + "another end"), (12, "123 456"), (None, None),
    ]
    rows = [(i, t, "en" if i and i % 2 else None, None, None, 0.5, True, "x", "y", 9, "z", 3, "d", "g", "w", "v", "l") for i, t in texts]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (5, None), (None, 1), (8, 0), (99, 1)], "doc_id long, toxic int")
