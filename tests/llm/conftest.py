"""Small fixtures: awkward rows that every operator has to stand."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, schema=DOCS):
        return spark.createDataFrame([(*r, *[None] * (5 - len(r)))[:5] for r in rows] if schema == DOCS else rows, schema)

    return make


@pytest.fixture(scope="session")
def sample():
    import duckdb

    return duckdb.sql("SELECT doc_id, text, lang, source, n_chars FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()


LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 4000
LINE = "a line of text that many documents share"


@pytest.fixture(scope="session")
def awkward():
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "one two three"), (6, LONG), (7, LONG), (None, "a null id " * 5), (8, f"{LINE}\nown line of document eight"),
        (9, f"  {LINE.upper()}  \nown line of document nine"), (10, f"{LINE}\n{LINE}\nlast"), (11, "same row twice"), (11, "same row twice"), (12, "Ünïcode 漢字 \U0001f600 x<|endoftext|>y  z\n\n "), (13, "same row twice"),
        (13, "another text under an id that is taken"), (14, "a\x1cb   c d 'tis it's ITS, end."),
    ]
