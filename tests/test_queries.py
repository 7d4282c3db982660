"""Every registered query against its SQL on the small tables."""

import oracle
import pytest

from rollbook.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), db, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
