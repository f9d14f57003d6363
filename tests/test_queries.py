"""Every registered query against its DuckDB text on the smallest test tables."""

from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module
from tidemart.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are missing")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    run, oracle = QUERIES[name], ORACLES[name]
    got, want, differences = compare(spark, con, run, oracle, SF_DIR)
    assert differences == [] and got == want and got > 0


def test_comparison_notices_a_difference(spark, con):
    run = QUERIES["a1_first_seen"]
    wrong = "SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS first_date FROM orders GROUP BY ALL"
    assert compare(spark, con, run, wrong, SF_DIR)[2]


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "goodsSalesPrice" in df.columns


def test_every_query_has_a_reference():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
