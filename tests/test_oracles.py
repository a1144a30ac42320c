"""Every registered query against its checking SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, tables
from clipcatalog.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return tables(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    compare(spark, db, QUERIES[name], FOLDER, ORACLES.get(name))


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["id", "title", "url_tiktok"]
    assert df.count() > 0
