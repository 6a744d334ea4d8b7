"""Every registered query with an oracle, next to DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_names():
    assert set(ORACLES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 34 and df.count() > 0


@pytest.mark.parametrize("name", ORACLES)
def test_equals_oracle(spark, duck, name):
    assert difference(entry.queries()[name](spark, FOLDER), duck, ORACLES[name]) is None
