import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, rank string, copies string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    prose = "the cat and the dog went over the hill to see what the old man had in his house. " * 5
    extra = ("x", "y", "z")
    rows = [(1, prose, "en", "a", 1, *extra), (1, prose, "en", "a", 1, *extra), (2, prose + "end", "en", "a", 1, *extra),
            (3, None, "en", "b", None, *extra), (4, "", None, None, 0, *extra), (5, " \n\t ", "en", "b", 4, *extra),
            (6, "word", "fr", None, 4, None, None, None), (7, "12 34 !!", "fr", "c", 8, *extra),
            (8, "mot " * 60_000, "fr", "c", 240_000, *extra), (9, prose.upper(), "en", "b", 1, *extra),
            (10, "été 😀 <|endoftext|>  deux\n\n espaces ", "fr", "c", 1, *extra), (None, prose, None, "a", 1, *extra)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
