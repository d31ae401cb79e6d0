import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rows string, id string, copies string"
LONG = " ".join(f"w{i % 4001}x{i % 997}" for i in range(60_000))
BASE = " ".join(f"alpha{i}" for i in range(200))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing column names."""
    rows = [
        (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE + " one more", "de", None), (3, BASE + " one more", "de", None),
        (4, None, "en", "a"), (5, "", "en", "b"), (6, " \t\n ", None, "b"), (7, LONG, "en", "b"), (8, LONG + " end", "en", "c"),
        (None, BASE.upper(), None, None), (None, "Über Straße; naïve café\nUnder the MIT License", "de", "é"), (9, "Short", "en", "Z"),
        (10, "Released under the MIT License.\nsame line of text\n x \nSAME LINE OF TEXT ", "en", "a"),
        (11, "\nsame line of text\n\nother", "en", "a"), (12, "一二三四五六七八九十\nab", "zh", "a"), (13, " 一二三四五六七八九十\t", "zh", "a"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", "y", None) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def pairs(frame):
    """(doc_id, text) of all rows."""
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
