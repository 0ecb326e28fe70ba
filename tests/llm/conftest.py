from __future__ import annotations

import random

import pytest

from tests.conftest import SAMPLE

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, block string"


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"{SAMPLE}/{name}.parquet")


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]]), with further columns of clashing names."""
    def build(*rows):
        full = []
        for doc_id, text, *rest in rows:
            lang, source = (*rest, *("en", "a")[len(rest):])
            full.append((doc_id, text, lang, source, len(text or ""), 0.5, "x", "y"))
        return spark.createDataFrame(full, COLUMNS)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, repeated rows, ties."""
    draw = random.Random(5)
    words = "the of and heed thon é straße ñandú 東京 it's 12345 ,.! 🙂   á".split(" ")
    long = " ".join(draw.choice(words) for _ in range(60_000))
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "The heed"), (4, "The heed"), (5, "The heed"), (None, "lost id"),
        (6, long), (7, "x" * 5000), (8, "don't I'LL go  twice\r\n\r\nnow"), (9, "the end", None, None), (10, "12 34"),
    ]
