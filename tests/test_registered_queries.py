"""Every registered query against its SQL counterpart on the smallest test data."""

import os

import pytest

from workload.compare import compare, database
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_without_pairwise_join_or_python(spark, con, name):
    forbidden = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")
    assert compare(spark, con, SF_DIR, name, forbidden) == ""
