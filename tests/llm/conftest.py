from __future__ import annotations

import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("driver tables absent")
    return SMALL


@pytest.fixture(scope="session")
def table(spark, small):
    """Rows of a driver table as dicts."""
    return lambda name: [r.asDict() for r in spark.read.parquet(f"{small}/{name}.parquet").collect()]


@pytest.fixture(scope="session")
def documents(spark):
    """A table like ``documents`` with clashing extra columns."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, ids string, key int"

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), "x", 7) for i, t in rows], kind)

    return make


#: Null, empty, blank, one word, repeated rows, a null key, white space of several kinds, a long text.
@pytest.fixture(scope="session")
def odd_rows():
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "one two\x0bthree four"),
        (5, "one two\x0bthree four"), (None, "Nameless text of six words here"), (None, None),
        (6, "Σίσυφος ÉTÉ İstanbul été \U0001F600!"), (7, "a\x00b \x1c c\x85d"),
        (8, "It's <|endoftext|> <|ENDOFTEXT|>x 123 don't"),
        (9, " ".join(f"w{i % 997}" for i in range(40_000))),
    ]
