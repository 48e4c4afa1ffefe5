"""Every catalog query against its reference SQL, over whole tables at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_point
from ackline.plans.catalog import QUERIES as CATALOG
from compare import duck_rows, spark_rows

SF_DIR = os.environ.get("ACKLINE_TEST_DIR", "/root/testdata/sf0.001")

QUERIES = {name: query for name, query in entry_point.queries().items() if name in CATALOG}
ORACLES = entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    assert (columns, rows) == duck_rows(SF_DIR, ORACLES[name])
    assert rows


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["topic", "partition_id", "epoch", "safe_next_offset"]


def test_oracles_belong_to_queries():
    assert set(QUERIES) == set(CATALOG)
    assert set(QUERIES) <= set(ORACLES) <= set(entry_point.queries())
