import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word " * 30_000 + "end."
#: nulls in every column, empty and blank texts, repeated rows, an id with two texts, a very long text
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. It was a fine day for all of them.", "en", "a", 79),
    (1, "The quick brown fox jumps over the lazy dog. It was a fine day for all of them.", "en", "a", 79),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "en", None, 4),
    (None, "A text without any id that is long enough to have shingles of its own here.", "en", "b", 10),
    (5, "The quick brown fox jumps over the lazy dog. It was a fine day for all of them.", None, "b", 79),
    (6, "ünï çødé 日本語 テキスト 😀 é", "de", "b", 20),
    (6, "another text of the same id, with words enough to count as one document here", "de", "b", 20),
    (7, LONG, "en", "c", len(LONG)),
    (8, "one", "en", "c", 3),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, DOC)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """Columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("score", "predicted", "id", "key", "k", "t", "n", "a", "b", "g", "r", "o", "next", "media", "piece", "start", "length", "removed", "component_id", "kept", "packed", "bands", "ids", "spans", "bucket", "block", "h", "band", "x", "y", "label", "words", "rank", "value")
    return odd.withColumns({n: F.lit("clash") for n in names})
