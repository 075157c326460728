import pytest

import __spark_entry__ as registry
from tests.oracle import connect, mismatch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


# Queries of the part that may be absent have tests of their own.
OWN = sorted(registry._QUERIES)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_oracle(spark, db, name):
    df = registry.queries()[name](spark, FOLDER)
    assert mismatch(df, db, registry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 80
    assert [r.periodo for r in rows] == sorted(r.periodo for r in rows)
