"""Every registered query against its SQL counterpart at the smallest scale."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, connect
from workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
