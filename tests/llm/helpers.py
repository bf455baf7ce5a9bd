"""Shared rows of the tests in this folder."""
import random

import pytest
from pyspark.sql import types as T
WORDS = ("the quick brown fox jumps over a lazy dog while seven wise owls watch from old trees and "
         "count stars that fall into deep rivers near quiet towns where people sleep").split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed"]) for _ in range(n))


def messy_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, ties, repeats, one long text, odd characters."""
    long_text = prose(1, 30_000)
    return [(1, prose(2, 60)), (2, prose(2, 60)), (2, prose(2, 60)), (3, None), (4, ""), (5, " \t\n "), (None, prose(3, 40)),
            (None, None), (6, long_text), (7, "a"), (8, "Ünïcödé — 😀 ́\x85\xa0 don't 12 34"), (9, prose(4, 50)),
            (-10, prose(4, 50).upper()), (11, "x" * 5000), (12, prose(5, 70) + " " + prose(2, 60))]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("TEXT", T.StringType()),
    ("score", T.DoubleType()), ("row", T.IntegerType()), ("n_words", T.StringType()), ("held_out", T.StringType())]])


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame([(i, t, "en", "other", 0.5, 7, "z", "no") for i, t in messy_rows()], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
