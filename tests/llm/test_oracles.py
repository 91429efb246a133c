"""Queries of this folder that have SQL, on the smallest tables."""

import os

import pytest

from litmill.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, same

FOLDER = os.environ.get("LITMILL_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no tables in {FOLDER}")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    same(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE_SQL[name])
