import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_id long, _text string, kept string, component_id string, ids string, key string, rep long"
)
PROSE = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty twenty-one twenty-two"
)
TEXTS = [
    (1, PROSE),
    (2, PROSE),
    (3, PROSE + " more"),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "short"),
    (8, "Short"),
    (9, "x" * 200_000),
    (10, "a b c d e f g h " * 5_000),
    (11, "same line here\nsame line here\nother\n\n"),
    (12, "▁ é 日本 🎉\r\n\0 end"),
    (13, PROSE),
    (13, PROSE),
    (None, PROSE),
    (None, "no id but words"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Awkward documents, with columns whose names clash with internal ones."""
    rows = [
        (i, t, None if k % 3 else "en", None if k % 4 == 0 else "s", None, 7, "z", "k", "c", "i", "q", 1)
        for k, (i, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
