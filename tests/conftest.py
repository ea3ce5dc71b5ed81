import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gradewise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def with_conf(spark):
    """Set session options for one test."""
    before = {}

    def set_conf(**conf):
        for name, value in conf.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


PRODUCTS_SCHEMA = (
    "row_id bigint, nutrition_grade_fr string, `saturated-fat_100g` double, fat_100g double, "
    "sugars_100g string, empty_100g double, constant_100g double, `nutrition-score-fr_100g` double, "
    "`vitamin.c_100g` double, packaging string"
)
NAN = float("nan")


@pytest.fixture(scope="session")
def products(spark):
    """Every grade, null and NaN cells, an empty and a constant column, a bad number, a dotted name."""
    rows = [
        (1, "a", 1.0, 2.0, "3.5", None, 7.0, 1.0, 0.1, "Boîte, 100% Carton!"),
        (2, "b", None, 2.0, "oops", None, 7.0, 2.0, 0.2, "glass"),
        (3, "c", 3.0, NAN, "1", None, 7.0, 3.0, None, None),
        (4, "d", 4.0, 5.0, None, None, 7.0, 4.0, 0.4, "Plástico  PET"),
        (5, "e", 9.0, 5.0, "2.5", None, 7.0, 5.0, 0.5, ""),
        (6, "B", 9.0, 5.0, "2.5", None, 7.0, 5.0, 0.5, "x-y_z"),
        (7, None, 1.0, 1.0, "NaN", None, 7.0, 5.0, 0.5, "A1 b2"),
    ]
    return spark.createDataFrame(rows, PRODUCTS_SCHEMA)
