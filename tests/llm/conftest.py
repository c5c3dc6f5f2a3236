import pytest

DATA = "/root/testdata/sf0.001"

#: Rows every operator must take: nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters.
ODD = [
    (1, "one two three four five", "en", "b", 3),
    (1, "one two three four five", "en", "b", 3),
    (2, None, None, None, None),
    (None, "no id " * 30, "en", None, 9),
    (3, "", "", "", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "a", 7),
    (5, "Éa 😀  x y " * 40, "fr", "a", 5),
    (6, "a " * 60000 + "mail me: x.y@example.org or 10.0.0.256", "en", "c", 1),
    (7, "a " * 60000 + "mail me: x.y@example.org or 10.0.0.256", "en", "c", 1),
    (-8, "one two three four five", None, "b", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 AS fp", "'x' AS row", "2 AS size", "'k' AS key", "3 AS copies", "'t' AS t", "4 AS h", "5 AS keys", "6 AS target", "7 AS base")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
