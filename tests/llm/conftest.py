from __future__ import annotations

import os

import pytest

# Python workers find the package whatever folder the tests are started from.
_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [_root, os.environ.get("PYTHONPATH")]))

# Nulls in every column, empty texts, ties, repeated rows and columns whose names clash with results.
ODD_SCHEMA = "doc_id long, text string, n_words long, kept string, block long, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    words = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, words, 5, "x", 7, 1),
        (1, words, 5, "x", 7, 1),
        (2, words.upper() + " tail", None, None, None, None),
        (3, None, 1, "y", 2, None),
        (4, "", 1, "y", 2, 0),
        (None, words, 1, "y", 2, 0),
        (None, None, None, None, None, None),
        (6, "one two", 1, "z", 2, 7),
        (7, " \n\t ", 1, "z", 2, 4),
        (8, "é" * 5000 + " " + "long" * 3000, 1, "z", 2, 4),
        (9, words + " " + words, 1, "z", 2, 4),
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
