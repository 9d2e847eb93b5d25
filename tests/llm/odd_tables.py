"""Fixtures that the tests of the operators share."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=("the", "cat", "sat", "mat", "dog", "ran", "far", "and", "near", "house", "tree", "river", "stone")):
    r = random.Random(seed)
    return " ".join(r.choice(vocabulary) + r.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and long texts, ties and repeats."""
    rows = [(i, prose(i, 60 + 7 * i), "en", f"s{i % 4}", 0) for i in range(24)]
    rows += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \n\t ", "fr", "s1", 4), (None, "no id here", "en", "s1", 1),
             (103, "The CAT sat", "en", None, 1), (103, "The CAT sat", "en", None, 1), (104, rows[3][1], "en", "s9", 0),
             (105, "word " * 30_000 + prose(7, 500), "en", "s2", 0), (106, "é𝒳 naïve " + prose(8, 80).upper(), "fr", "s2", 0)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
