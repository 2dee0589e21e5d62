"""Every query with an SQL twin, row by row, at the smallest scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workloads.compare import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_twin(spark, duck, name):
    assert compare(spark, duck, name, queries()[name], oracle_sql()[name], SF) is None


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
