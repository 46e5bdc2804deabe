"""Every registered query against its SQL at the smallest scale."""

import os

import oracle
import pytest

from daybook.plans import registered

FOLDER = os.environ.get("DAYBOOK_TEST_SF", "/root/testdata/sf0.001")
QUERIES = registered()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, QUERIES[name], FOLDER) == ""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["kmeans_segments", "kmeans_centroids", "elbow", "hold_out", "score_clients"])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
