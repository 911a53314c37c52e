"""Every registered query against its DuckDB oracle SQL on the smallest data
(the same comparison the build driver runs at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import digest, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402

from brickyard.plans.registry import QUERIES as OWN  # noqa: E402

#: Approximate by design: tests/test_vectors.py measures its recall against the exact search.
NO_SQL = {"vector_topk_lists"}
KEYS = sorted(set(OWN) - NO_SQL)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_oracle():
    assert set(OWN) <= set(E.queries()) and set(OWN) - NO_SQL == set(OWN) & set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_small, key):
    sdf = E.queries()[key](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns
