"""Small tables with everything that may go wrong in a row."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import prose  # noqa: E402

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key_hi string, kept string, n_lines int, score string"


@pytest.fixture(scope="session")
def odd_rows():
    long_text = prose(99, 30_000)
    texts = [
        (1, prose(1, 120)), (1, prose(1, 120)),      # a repeated row
        (2, None), (3, ""), (4, " \t\n "), (5, "one"),
        (None, prose(2, 80)), (None, None),          # no id
        (6, prose(3, 70)), (6, prose(4, 70)),        # one id, two texts
        (7, prose(1, 120)), (8, prose(1, 119)),      # copies and near copies
        (9, long_text), (10, "lead " + long_text),
        (11, "é" * 900), (12, "é" * 900), (13, "\x00\r\n" * 50), (14, "日本語 " * 60),
    ]
    return [(i, t, "en", "s", len(t or ""), "k", "yes", 3, "x") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
