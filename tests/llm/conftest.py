import os
import random

import pytest

HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = HOME


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, ties, repeats, long texts, clashing bytes."""
    rng = random.Random(5)
    letters = ["a", "b", "Ab", "é", "日本", "x1", "can't", "  ", "\n", "\x0b", "!", "#", "İ", " "]
    made = [" ".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    long = " ".join(f"w{rng.randint(0, 300)}" for _ in range(30000))
    return [None, "", " ", "\n\n", "one", "!!", *made, made[0], made[0], long]


SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The texts as documents with null columns, a repeated row, a null id, and columns whose names operators use themselves."""
    rows = [(i, t, None if i % 5 == 0 else "en", None, None if t is None else len(t), i, "x") for i, t in enumerate(odd_texts)]
    rows += [rows[-2], (None, "a b c", None, None, 5, None, None)]
    return spark.createDataFrame(rows, SHAPE + ", hits long, curve string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SHAPE)
