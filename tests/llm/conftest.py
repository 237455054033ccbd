import pytest

LONG = "\n".join(f"line {n} of a very long text with words {n * 7} and {n * 13}" for n in range(4000))

# Nulls in every column, empty and blank texts, a very long text, a tie, a repeated row, and clashing names.
AWKWARD = [
    (1, "the cat sat on the mat today " * 12, "en", "a", 1, "x", 1, 0.5),
    (2, None, None, None, None, None, None, None),
    (3, "", "en", "b", 0, "x", 2, 0.5),
    (4, " \n\t\n ", "en", "b", 5, "x", 2, 0.5),
    (None, "nobody knows the id of this text", "en", "a", 9, "x", 2, 0.5),
    (5, LONG, "en", "c", len(LONG), "x", 2, 0.5),
    (6, LONG, "en", "c", len(LONG), "x", 2, 0.5),
    (7, "same row twice", "en", "a", 14, "x", 2, 0.5),
    (7, "same row twice", "en", "a", 14, "x", 2, 0.5),
    (7, "same id, other text", "en", "a", 19, "x", 2, 0.5),
    (8, "éÉ \U0001f600 中文   end", "xx", "\U0001f600", 9, "x", 2, 0.5),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, hits string, k0 int, score double"
)


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
