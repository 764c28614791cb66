from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ba de fi go lu ma ne pi ro su ta ve wi xo zu ka".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    shared = sentence(rng, 80)
    rows = [
        (1, None, "en", None, None),
        (2, "", None, "s", 0),
        (None, sentence(rng, 60), "en", "s", 1),
        (None, sentence(rng, 60), None, None, None),
        (5, " \t\n\x0b\x0c\r ", "en", "s", 7),
        (6, "one two three", "en", "s", 13),
        (7, "1234 5678 !!!", "de", "s", 9),
        (8, "é漢字 ǅ \U0001f600 naïve " * 20, "fr", "s", 9),
        (9, "a" * 30_000, "en", "s", 9),
        (10, sentence(rng, 20_000), "en", "s", 9),
        (11, "line\n" * 500, "de", "s", 9),
    ]
    rows += [(20, shared, "en", "s", 1)] * 3  # repeated rows
    rows += [(k, shared + (" " + sentence(rng, 4) if k % 2 else ""), "en", "s", 1) for k in range(21, 27)]
    rows += [(k, sentence(rng, rng.randint(1, 150)), rng.choice(["en", "de"]), "s", 1) for k in range(30, 60)]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCS).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark, edges):
    """Documents with extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    for name in "score kept key pos nid node band pii items n_words rejected piece length".split():
        edges = edges.withColumn(name, F.lit(name))
    return edges


def by_row(df, *columns):
    """Result rows as a sorted list, nulls as text."""
    return sorted(str([r[c] for c in columns]) for r in df.collect())
