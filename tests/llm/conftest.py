import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words, alphabet="abcdefghij"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows and ids, and near copies."""
    rng = random.Random(5)
    base = prose(rng, 120)
    rows = [
        (0, base, "en", "a", len(base)), (0, base, "en", "a", len(base)), (1, base, None, None, None), (2, base + " tail", "en", "b", 1),
        (3, None, None, None, None), (4, "", "fr", "a", 0), (5, " \n\t", "fr", "a", 3), (None, base, "en", "b", 1), (None, None, None, None, None),
        (6, prose(rng, 20000, "klmnop"), "fr", "c", 5), (7, "x" * 50000, "en", "c", 5), (8, "one", "en", "a", 3), (9, "été à la façon ÉTÉ", "fr", "a", 1),
        (10, "a b c d e f g h i j " * 40, "en", "d", 1), (10, prose(rng, 60), "en", "d", 1), (11, "line here\nline here\n\nline here\n", "en", "d", 1),
    ]
    return spark.createDataFrame(rows, DOCUMENTS).withColumn("size", __import__("pyspark").sql.functions.lit("theirs"))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
