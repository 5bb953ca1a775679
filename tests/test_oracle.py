"""Every query gives what its SQL gives."""

import pytest

from __spark_entry__ import entry
from tabwright.catalog import QUERIES, SQL, load_all
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, FOLDER, QUERIES[name], SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["split", "labels", "text"]
    assert df.count() > 0
