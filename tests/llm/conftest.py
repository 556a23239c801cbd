import pytest

DOCS = "doc_id long, text string"

#: Nulls, empty texts, ties, repeated rows, odd characters; with columns whose names clash with inner ones.
ODD = [
    (1, "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen."),
    (2, "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen."),
    (2, "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen."),
    (3, None),
    (4, ""),
    (5, "   \t\n "),
    (6, "word"),
    (7, "\U0001f600 ... !!! \x00\x1c ffi ÄÖÜ ǅ Σς İ"),
    (None, "An id is missing here, but the text is as good as any other text of this table."),
    (8, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    clash = "tm_score string, cls string, h string, file string, row string, keep string, digest string, label string, tokens string"
    fields = ", ".join([DOCS, clash])
    return spark.createDataFrame([(*r, *"abcdefghi") for r in ODD], fields)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
