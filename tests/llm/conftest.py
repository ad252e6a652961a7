import pytest


@pytest.fixture(scope="session")
def hard(spark):
    """Documents with null ids and texts, empty, very long, equal and repeated ones, and columns with clashing names."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
    rows = [
        (1, base * 3, "en", "a", 5), (2, (base * 3).upper(), "en", "a", 5), (3, base * 3, None, None, None), (4, "", "en", "b", 0),
        (5, None, "de", "b", None), (6, "one", "en", "c", 3), (7, "one two three four five", "en", "c", 1), (8, " \n\t ", "en", None, 1),
        (9, base * 2 + "Released under the MIT License. " + base, "fr", "a", 9), (10, "É" * 70 + "ß straße " * 40, "de", "b", 2),
        (11, base * 3000, "en", "a", 1), (12, base * 2 + "different tail here for this one text " * 4, "en", "a", 1),
        (13, "ab" * 400, "xx", "c", 1), (14, "\x00\x01 odd   bytes \U0001f600 end", "en", "c", 1), (7, "one two three four five", "en", "c", 1),
        (None, "null id text one two three", "en", "a", 1), (None, base * 3, "en", "a", 1), (15, "word " * 500, "en", "d", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for name in ("kept", "node", "score", "shard", "_id", "n", "row", "rng", "copy_of", "_part", "key", "size", "sha"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
