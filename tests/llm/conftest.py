"""Awkward documents for every corpus operator."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; documents may bring them along.
CLASHING = ["size", "shard", "fp", "label", "grp", "bin", "start", "chunk", "score", "part", "d", "held", "kept", "x"]


def prose(seed: int, words: int, line: int = 12) -> str:
    rng = random.Random(seed)
    parts = ["the", "of", "er", "tion", "an", "re", "he", "ou", "th", "ea", "st", "or", "ble", "ti"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(made[i : i + line]) for i in range(0, len(made), line))


def awkward_rows() -> list[tuple]:
    long_text = prose(1, 6000)
    base = prose(2, 120)
    return [
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \n\t ", "de", None, 4),
        (4, base, "en", "a", len(base)),
        (4, base, "en", "a", len(base)),
        (5, base, "fr", "b", len(base)),
        (6, base + " tail", None, None, None),
        (7, long_text, "en", "a", len(long_text)),
        (8, long_text[5000:9000] + " ünïcödé 日本語 " + prose(3, 80), "de", "b", 1),
        (None, prose(4, 60), "en", "a", 1),
        (9, "!!! 123 ***", "en", "a", 11),
        (10, "password = 'abcdef123456' and token=short", "en", "a", 40),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    from pyspark.sql import functions as F

    return awkward.select("*", *[F.lit("clash").alias(c) for c in CLASHING])
