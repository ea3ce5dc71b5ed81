import hashlib

from pyspark.sql import functions as F

from gradewise.functions import column, hash_bucket, is_missing, majority, normalize_text, row_key
from gradewise.operators.sampling import fold_of, hash_split


def test_column_takes_names_literally(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "sat-fat_100g", "tick`ed"])
    assert df.select(column("a.b"), column("sat-fat_100g"), column("tick`ed")).first() == (1, 2, 3)


def test_missing_is_null_or_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),)], "x double")
    assert [r[0] for r in df.select(is_missing(F.col("x"))).collect()] == [False, True, True, False]


def test_normalize_text_deletes_what_is_not_plain(spark):
    df = spark.createDataFrame([("Crème  Brûlée, 20%\n",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(normalize_text(F.col("t"))).collect()] == ["crme  brle 20", "", None]


def test_hash_bucket_is_the_head_of_the_salted_digest(spark):
    expected = int(hashlib.md5(b"split:42:17").hexdigest()[:8], 16)
    assert spark.range(17, 18).select(hash_bucket(F.col("id"), "split:42")).first()[0] == expected


def test_rows_with_a_null_key_stay(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (4,)], "k int")
    train, test = hash_split(df, "k")
    assert train.count() + test.count() == 4
    assert df.filter(fold_of("k").isNull()).isEmpty()


def test_row_key_depends_on_all_cells_and_on_their_places(spark):
    rows = [("x", None), (None, "x"), ("x", None), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    first, second, third, fourth = [r[0] for r in df.select(row_key(df)).collect()]
    assert first == third and len({first, second, fourth}) == 3


def test_row_key_takes_nested_columns(spark):
    df = spark.sql("select map('a', 1) m, array(struct(1 x)) s, null n union all select map('a', 2), array(), null")
    keys = [r[0] for r in df.select(row_key(df)).collect()]
    assert len(set(keys)) == 2 and all(len(k) == 32 for k in keys)


def test_row_keys_do_not_collide(spark):
    df = spark.range(200_000).selectExpr("id", "id % 7 as a", "cast(id % 3 as string) as b")
    assert df.select(row_key(df).alias("k")).distinct().count() == 200_000
    same = df.select("a", "b")
    assert same.select(row_key(same).alias("k")).distinct().count() == 21


def test_majority_needs_more_than_half(spark):
    df = spark.createDataFrame([(1, 1, 0, 0), (1, 1, 1, 0), (0, 0, 1, 0)], ["a", "b", "c", "d"])
    four = df.select(majority([F.col(c) for c in "abcd"])).collect()
    three = df.select(majority([F.col(c) for c in "abc"])).collect()
    assert [r[0] for r in four] == [0, 1, 0]
    assert [r[0] for r in three] == [1, 1, 0]
