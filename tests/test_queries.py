"""Every registered query against its SQL counterpart on the smallest data."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from ledgerwright.plans.oracles import ORACLES
from ledgerwright.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.queries()) - set(entry.CORPUS_QUERIES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    found = difference(spark, db, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert found.startswith("ok"), found


def test_entry(spark):
    assert entry.entry(spark).count() > 0
