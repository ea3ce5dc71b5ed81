import pytest

from gradewise.operators.cleaning import (
    by_suffix,
    cast_numeric,
    clean,
    clean_summary,
    dense_columns,
    dense_profile,
    malformed_profile,
    null_profile,
    pick_columns,
    without_dots,
)

CANDIDATES = ["saturated-fat_100g", "fat_100g", "sugars_100g", "empty_100g", "constant_100g", "vitamin.c_100g"]


def test_picker_takes_suffix_minus_exclusions(products):
    assert pick_columns(products, by_suffix()) == CANDIDATES
    assert pick_columns(products, None) == []
    assert pick_columns(products, lambda names: names[:2]) == products.columns[:2]


def test_bad_numbers_become_null_and_are_counted(products):
    numeric = cast_numeric(products, CANDIDATES)
    assert dict(numeric.dtypes)["sugars_100g"] == "double"
    values = [r["sugars_100g"] for r in numeric.orderBy("row_id").collect()]
    assert values[:6] == [3.5, None, 1.0, None, 2.5, 2.5] and values[6] != values[6]
    bad = {r["column"]: r["malformed_count"] for r in malformed_profile(products, CANDIDATES).collect()}
    assert bad == {c: int(c == "sugars_100g") for c in CANDIDATES}


def test_profile_counts_null_and_nan(products):
    rows = null_profile(cast_numeric(products, CANDIDATES), CANDIDATES).collect()
    assert {r["column"]: r["null_count"] for r in rows} == {
        "saturated-fat_100g": 1,
        "fat_100g": 1,
        "sugars_100g": 3,
        "empty_100g": 7,
        "constant_100g": 0,
        "vitamin.c_100g": 1,
    }
    assert {r["row_count"] for r in rows} == {7}
    assert [r["null_share"] for r in rows if r["column"] == "sugars_100g"] == [3 / 7]


def test_dense_columns_come_by_share_then_position(products):
    numeric = cast_numeric(products, CANDIDATES)
    assert dense_columns(numeric, CANDIDATES) == [
        "constant_100g",
        "saturated-fat_100g",
        "fat_100g",
        "vitamin.c_100g",
        "sugars_100g",
    ]
    assert dense_columns(numeric, []) == []
    assert [r["rank"] for r in dense_profile(numeric, CANDIDATES).orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_share_at_the_limit_is_dropped(spark):
    df = spark.range(1000).selectExpr(
        "case when id = 0 then 1d end as at_limit", "case when id < 2 then 1d end as under_limit"
    )
    assert dense_columns(df, ["at_limit", "under_limit"]) == ["under_limit"]


def test_empty_table_has_no_share_and_no_dense_column(spark):
    df = spark.createDataFrame([], "x double")
    assert null_profile(df, ["x"]).first()["null_share"] is None
    assert dense_columns(df, ["x"]) == []


def test_clean_projects_features_target_and_clean_text(products):
    cleaned, features = clean(
        products, by_suffix(), target="nutrition_grade_fr", keep=["row_id", "packaging", "not there"]
    )
    assert cleaned.columns == [*features, "nutrition_grade_fr", "row_id", "packaging"]
    assert [r["packaging"] for r in cleaned.orderBy("row_id").collect()] == [
        "bote 100 carton",
        "glass",
        None,
        "plstico  pet",
        "",
        "xyz",
        "a1 b2",
    ]
    assert clean_summary(cleaned, features, ["packaging"]).first() == (7, 5, 1)


def test_clean_without_target_or_picker(products):
    cleaned, features = clean(products, None, target="absent", keep=["row_id"])
    assert features == [] and cleaned.columns == ["row_id"]


def test_profile_is_one_aggregate(products):
    plan = null_profile(cast_numeric(products, CANDIDATES), CANDIDATES)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1


def test_names_lose_their_dots(spark, products):
    assert "vitamin_c_100g" in without_dots(products).columns
    with pytest.raises(ValueError, match="collide"):
        without_dots(spark.createDataFrame([(1, 2)], ["a.b", "a_b"]))
