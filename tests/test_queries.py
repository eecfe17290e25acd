"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import database, difference

from queries import ORACLES, QUERIES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
