import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, size long, score double, spans string, stratum string, bucket int, sequence_id int"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abdehilnorst") for _ in range(rng.randint(2, 8)))
    long = " ".join(word() for _ in range(30_000))
    story = " ".join(word() for _ in range(120)) + ".\nsecond line here\n" + " ".join(word() for _ in range(80))
    rows = [
        (None, None), (None, "null id " * 30), (1, None), (2, ""), (3, "   \n\t "), (4, story), (4, story), (5, story), (5, "another text of a repeated id " * 5), (6, long),
        (7, story + " tail"), (8, "é🎉 Σσς İ 漢字 <|endoftext|> it's 12²"), (9, "\x00\x1c odd \x85 signs"), (10, "x" * 70_000), (11, "one"), (12, "a\n\na\n\na"),
    ]
    return [(i, t, None if i == 6 else "en", "s", None, "k", 1, 0.5, "x", "other", 3, 9) for i, t in rows]


@pytest.fixture
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
