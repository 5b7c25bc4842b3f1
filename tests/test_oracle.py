"""Every registered query against its DuckDB oracle on the smallest data set
(the driver repeats this at sf0.01)."""

import os
import sys

import pytest
from shared import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from lakeloom.plans import catalog  # noqa: E402
from oracle_check import digest, duck, type_mismatches  # noqa: E402

# the training-data queries have tests of their own
QUERIES = {n: q for n, q in entry.queries().items() if n in catalog.QUERIES}
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(cols) > 0
        return
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert type_mismatches(df.schema, con, ORACLES[name]) == []
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_rating" in df.columns


def test_every_query_has_an_oracle_or_is_known_rows_only():
    assert set(QUERIES) - set(ORACLES) == set()
