"""Small documents with the awkward cases that every operator has to take."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empties, repeated rows and ids, a long text, a text without blanks, copies."""
    base = [prose(k, 60) for k in range(6)]
    return [
        (1, base[0]), (2, base[1]), (3, base[0]), (3, base[0]), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one two three"),
        (None, base[2]), (9, base[2]), (10, prose(99, 4000)), (11, "x" * 20000), (12, base[3] + "\n" + base[3]), (12, base[4]),
        (13, "é" * 30 + " " + base[5]), (14, "ab " * 300),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
