import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int = 0) -> str:
    return " ".join(f"w{(i * 7919 + seed * 104729) % 5003}" for i in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls, blanks, a very long text, copies, near copies, repeated rows, odd characters."""
    base = words(200, 1)
    near = base.replace("w7919 ", "changed ", 1) if "w7919 " in base else base + " changed"
    return [
        (1, base, "en", "a", 10),
        (2, base, "en", "a", None),
        (3, near, None, "a", 10),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t ", "en", None, 3),
        (7, words(30000, 2), "en", "b", 1),
        (8, "one two", "en", "b", 7),
        (9, "É ß ǅ 漢字 \U0001f600 don't <|endoftext|> á", "fr", "c", 1),
        (10, "line\n" * 80 + words(60, 3), "en", "c", 1),
        (10, "line\n" * 80 + words(60, 3), "en", "c", 1),
        (-3, "a negative id", "en", "c", 1),
        (None, "an id that is null " + words(80, 4), "en", "c", 1),
        (None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, DOCS)
    for name in ("shard", "part", "row", "fp", "score", "clauses", "size", "unit", "start", "host", "label", "item", "m", "sh", "path", "ids", "range"):
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
