import random

import pytest

WORDS = "the of and lorem ipsum dolor sit amet river stone cloud seven maple engine quiet harbor winter candle meadow copper".split()
# Columns that operators also make.
EXTRA = "lang string, kept boolean, score double, chunk long, row int, signature binary, digest_ string, x double, class long, removed string, ids string, bucket int"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(words))


def odd_rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    other = base.split()
    other[10] = "altered"
    passage = prose(9, 30)
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, " ".join(other)), (5, base.upper() + "\n\t "), (6, None), (7, ""), (8, " \n\t "), (9, "one two"), (10, "one  two"), (11, "One two"),
        (12, prose(2, 40) + "\n" + passage + "\n" + prose(3, 40)), (13, prose(4, 30) + "\n" + passage), (14, "a" * 3000), (15, "ab " * 4000), (16, prose(5, 6000)), (17, "héé 日本語 👩‍👩‍👧 " * 9), (18, "héé 日本語 👩‍👩‍👧 " * 9),
        (19, "x"), (19, "x"), (20, base), (20, base), (None, base), (None, None), (21, "line one of a text here\n\nline one of a text here\nline 1 of a text here\n"), (22, prose(6, 3000)), (22, prose(7, 10)),
    ]
    return [(i, t, "en", True, 0.5, 7, 1, b"s", "d", 1.0, 3, "r", "i", 2) for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, short, long and repeated texts, repeated and missing ids, columns with clashing names."""
    return spark.createDataFrame(odd_rows(), f"doc_id long, text string, {EXTRA}").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
