"""Every registered query against its SQL twin, on whole tables."""

import __spark_entry__ as entry
import pytest
from compare import compare, connect

from tamizal.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
# the queries of the library itself; those of the folder for training data have tests beside it
QUERIES = {n: run for n, run in entry.queries().items() if n in catalog.QUERIES}
ORACLE = {n: sql for n, sql in entry.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
