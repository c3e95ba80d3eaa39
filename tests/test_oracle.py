"""Every registered query against DuckDB on the smallest test tables."""

import os

import pytest

from checks.compare import compare, oracle_connection
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, SF, QUERIES[name], ORACLES.get(name))
    assert result["status"] in ("match", "rows only"), result
    assert result["rows"] > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
