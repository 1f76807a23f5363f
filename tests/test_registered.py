"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    rows = frame.collect()
    if name in oracle_sql():
        assert difference(rows, frame.columns, duck.execute(oracle_sql()[name])) == ""
    else:
        assert rows


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "score"]
