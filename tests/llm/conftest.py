"""Small tables with nulls, repeated rows, ties, long texts and clashing names."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, set_id long, root long, rule int, kind string"


def words(n: int, seed: int = 0) -> str:
    """n words that differ from those of another seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append("".join("abcdefghijklmnoprstuvw"[(x >> s) % 22] for s in range(20, 20 + 4 * (3 + x % 5), 4)))
    return " ".join(out)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang]) rows, with columns whose names the operators use themselves."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, "x", 1, 2, 3, "k") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Rows that every operator must take."""
    long_text = words(4000, 5)
    return make(
        [
            (0, None), (1, ""), (2, "  \n\t"), (3, "ab"), (4, words(80, 1)), (4, words(80, 1)), (5, words(80, 1)),
            (None, words(60, 2)), (None, None), (6, long_text), (7, "é" * 300), (8, "a" * 5000), (9, "日本語 テキスト 123 😀"),
            (10, words(60, 3) + "\n" + words(60, 3)), (2**62, words(70, 4)),
        ]
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.where(F.lit(False))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, None), (5, 0, 1), (6, None, 0), (10, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
