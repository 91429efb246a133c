"""Every query of the package against its oracle, or at least run, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from litmill.plans import registry
from tests.oracle import connect, same

FOLDER = os.environ.get("LITMILL_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no tables in {FOLDER}")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql:
        same(frame, con, sql)
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["source_title", "n_unique", "n_records"]
