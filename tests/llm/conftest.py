import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, source string, lang string, n_chars long, size long, score double, row string, key long"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns whose names operators use."""
    passage = " ".join(f"w{i}" for i in range(70))
    rows = [(1, passage, "a"), (2, "x y " + passage + " z", "a"), (3, None, None), (4, "", "b"), (5, "short one", None), (6, "short one", "b"),
            (6, "short one", "b"), (None, "no id " + passage, "a"), (None, None, None), (None, "second without id", "c"),
            (7, "long " * 30000 + passage, "c"), (8, "é ü ß 漢字 " * 40, "c"), (9, "é ü ß 漢字 " * 40, "a"), (10, " \t\n ", "b")]
    return spark.createDataFrame([(i, t, s, None, None, 1, 0.5, "r", 7) for i, t, s in rows], ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD)
