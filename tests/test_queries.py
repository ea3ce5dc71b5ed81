import pytest

import __spark_entry__ as spark_entry
from checks.compare import connect, differences
from checks.oracle import oracle
from checks.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(REGISTRY) == set(oracle())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, REGISTRY[name], oracle()[name]) is None


def test_entry_compares_three_models(spark):
    assert spark_entry.entry(spark).count() == 3
