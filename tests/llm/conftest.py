import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos string, w string, hi string, bucket string, id string"


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, repeated rows, equal ids, and columns named as the operators' own."""
    a, b = " ".join(prose(1, 80)), " ".join(prose(2, 3000))
    rows = [(1, a), (2, a), (2, a), (3, a + " tail"), (4, b), (5, b + " x"), (6, None), (7, ""), (8, " \n\t"), (None, a), (None, None), (9, "é" * 5000), (9, "other text here"), (10, "one two")]
    full = [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 4 else None, len(t) if t else None, "k", None, "w", "h", "b", str(k)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
