import pytest

import __spark_entry__ as spark_entry
from checks.compare import connect, differences
from gradewise.llm.queries import ORACLE, REGISTRY

SF_DIR = "/root/testdata/sf0.001"
NUMBERS = range(1, 14)


def test_one_query_per_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in REGISTRY) == list(NUMBERS)
    assert set(REGISTRY) | {"pipeline"} <= set(spark_entry.queries())
    assert set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(SF_DIR), SF_DIR, REGISTRY[name], ORACLE[name]) is None
