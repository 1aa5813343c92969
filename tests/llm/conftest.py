import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (2, "the quick BROWN fox jumps over the lazy dog near the old river bank today", "en", "b"),
    (3, "the quick brown fox jumps over the lazy dog near the old river bank again", "en", "a"),
    (4, "completely other words stand here and nothing is shared with any neighbour at all", "en", None),
    (5, None, "en", "a"),
    (6, "", None, "b"),
    (7, " \t\n ", "de", "c"),
    (8, "two words", "en", "a"),
    (9, "two  WORDS", "en", "a"),
    (8, "two words", "en", "a"),
    (None, "a row without an id but with some words in it", None, "b"),
]


@pytest.fixture(scope="session")
def spark():
    from segmetric.session import get_spark

    return get_spark("corpus-tests", cpus="4", shuffle_partitions=4)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(*r, r[2], r[0]) for r in TEXTS],
                                 "doc_id long, text string, lang string, source string, label string, repeats long")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
