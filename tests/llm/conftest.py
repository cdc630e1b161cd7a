import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark():
    from check_oracles import session

    return session()


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty, blank and long texts, copies, repeated rows, other scripts."""
    prose = " ".join(f"w{k * k % 9973}" for k in range(400))
    rows = [
        (1, prose, "en", "a"),
        (2, prose, "en", "a"),
        (3, prose + " tail", "en", None),
        (4, None, None, None),
        (5, "", "en", "b"),
        (6, " \n\t ", "de", "b"),
        (7, "x", "de", "b"),
        (7, "x", "de", "b"),
        (8, "same " * 60, "fr", "c"),
        (9, " ".join(["long", "words"] * 30_000), "fr", "c"),
        (10, "Текст на другом языке 日本語 😀\n" * 5, "es", "c"),
        (None, prose, "en", "a"),
        (None, None, None, None),
        (-3, prose[200:], "es", "d"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
