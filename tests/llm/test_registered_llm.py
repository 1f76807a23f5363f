"""Queries that SQL can state, against their SQL, and all of them for rows and columns."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import connect, difference  # noqa: E402

from termloom.llm.oracle import ORACLE  # noqa: E402
from termloom.llm.registered import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables not there")
    frame = QUERIES[name](spark, FOLDER)
    assert difference(frame.collect(), frame.columns, connect(FOLDER).execute(ORACLE[name])) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
