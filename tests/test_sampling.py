import hashlib

import pytest
from pyspark.sql import functions as F

from gradewise.operators import sampling
from gradewise.operators.sampling import balanced_subsets, fold_of, hash_split, random_split, subset_conditions
from gradewise.sources import materialize


def test_split_is_whole_disjoint_and_layout_free(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = hash_split(df, "k")
    kept = {r[0] for r in train.collect()}
    assert {r[0] for r in hash_split(df.repartition(3), "k")[0].collect()} == kept
    assert kept | {r[0] for r in test.collect()} == set(range(5000))
    assert test.count() == 5000 - len(kept)
    assert 0.77 < len(kept) / 5000 < 0.83


def test_ratio_seed_and_text_keys(spark):
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"))
    assert hash_split(df, "k", ratio=1.0)[1].isEmpty()
    assert hash_split(df, "k", ratio=0.0)[0].isEmpty()
    one, two = (hash_split(df, "k", seed=s)[0] for s in (1, 2))
    assert not one.exceptAll(two).isEmpty()
    assert 0.45 < hash_split(df, "k", ratio=0.5)[0].count() / 2000 < 0.55


def test_folds_do_not_follow_the_split(spark):
    df = spark.range(6000).withColumnRenamed("id", "k")
    counts = hash_split(df, "k")[0].groupBy(fold_of("k").alias("f")).count().collect()
    assert {r["f"] for r in counts} == {0, 1, 2}
    assert all(1450 < r["count"] < 1750 for r in counts)


def test_random_split_keeps_all_rows(spark):
    train, test = random_split(spark.range(1000))
    assert train.union(test).distinct().count() == 1000


def smallest_hashes(keys, subset, n):
    return set(sorted(keys, key=lambda k: hashlib.md5(f"subset:42:{subset}:{k}".encode()).hexdigest())[:n])


@pytest.mark.parametrize("digits", [0, 1, 4, 32])
def test_subsets_equal_ranking_by_hash(spark, monkeypatch, digits):
    """A class with 90 % of the rows, ranked whole or by some hash digits."""
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", digits)
    df = spark.range(2000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 20 == 0, 0).when(F.col("id") % 20 == 1, None).otherwise(1).alias("label"),
    )
    minority, majority = range(0, 2000, 20), [k for k in range(2000) if k % 20 > 1]
    rows = balanced_subsets(df, "k", subsets=3).collect()
    for subset in range(3):
        kept = {0: set(), 1: set()}
        for r in rows:
            if r["subset"] == subset:
                kept[r["label"]].add(r["k"])
        assert kept[0] == set(minority)
        assert kept[1] == smallest_hashes(majority, subset, 100)
    assert len(rows) == 3 * 200


def test_three_classes_and_equal_classes(spark):
    df = spark.range(90).select(F.col("id").alias("k"), F.when(F.col("id") < 10, 0).when(F.col("id") < 40, 1).otherwise(2).alias("label"))
    sizes = balanced_subsets(df, "k", subsets=2).groupBy("subset", "label").count().collect()
    assert len(sizes) == 6 and {r["count"] for r in sizes} == {10}
    equal = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 2).alias("label"))
    assert balanced_subsets(equal, "k", subsets=2).count() == 20


def test_subset_conditions_are_plain_filters(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") < 10).cast("int").alias("label"))
    condition = subset_conditions(df, "k", subsets=1)[0]
    plan = df.filter(condition)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_copies_of_a_key_stay_together(spark):
    """A third of the larger class is one key; it counts whole wherever its hash falls."""
    keys = [0] * 300 + list(range(1, 601))
    df = spark.createDataFrame([(k, 1) for k in keys] + [(10_000 + k, 0) for k in range(400)], "k int, label int")
    for subset, condition in enumerate(subset_conditions(df, "k", subsets=4)):
        kept = sorted(r["k"] for r in df.filter(condition & (F.col("label") == 1)).collect())
        order = sorted(set(keys), key=lambda k: hashlib.md5(f"subset:42:{subset}:{k}".encode()).hexdigest())
        expected = []
        while len(expected) < 400:
            key = order.pop(0)
            expected += [key] * keys.count(key)
        assert kept == sorted(expected)


def test_null_keys_are_split_by_content(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    train, test = hash_split(df, "k")
    for part, share in ((train, 0.8), (test, 0.2)):
        assert abs(part.filter("k IS NULL").count() / 1000 - share) < 0.04
    assert train.count() + test.count() == 3000
    folds = {r["f"]: r["count"] for r in df.filter("k IS NULL").groupBy(fold_of(sampling.identity(df, "k")).alias("f")).count().collect()}
    assert set(folds) == {0, 1, 2} and min(folds.values()) > 280
    labelled = df.withColumn("label", (F.col("v") % 10 == 0).cast("int"))
    kept = balanced_subsets(labelled, "k", subsets=2).groupBy("subset", "label").count().collect()
    assert {r["count"] for r in kept} == {300}


@pytest.mark.parametrize("copies", [1, 4, 3000])
def test_stored_subsets_are_the_same_rows(spark, monkeypatch, copies):
    """Hashed once, or once more where many copies of a key move the cut; rows without key and without label too."""
    monkeypatch.setattr(sampling, "MASK_BITS", 3)
    key = F.when(F.col("id") < copies, -1).when(F.col("id") % 50 != 7, (F.col("id") / (1 + copies % 3)).cast("int"))
    label = F.when(F.col("id") % 11 == 3, 0).when(F.col("id") % 40 == 1, None).when(F.col("id") % 7 == 2, 2).otherwise(1)
    df = materialize(spark.range(6000).select("id", key.alias("k"), label.alias("label")), "rows")
    stored, inside = sampling.store_subsets(
        df, "k", lambda rows, told: materialize(rows.select("id", "label", *told), "told"), subsets=4
    )
    plain = sampling.subset_conditions(df, "k", subsets=4)
    for i in range(4):
        kept, expected = (sorted(r.id for r in rows.select("id").collect()) for rows in (stored.filter(inside[i]), df.filter(plain[i])))
        assert kept == expected and len(kept) > 1500


def test_a_cut_is_near_the_share_of_its_class():
    assert sampling._near_cut(50, 100)[0] < "80000000" < sampling._near_cut(50, 100)[1]
    assert sampling._near_cut(999_999, 1_000_000)[1] == "g" and sampling._near_cut(1, 1_000_000)[0] == "00000000"
    low, high = (int(h, 16) / 2**32 for h in sampling._near_cut(40_000_000, 100_000_000))
    assert 0.395 < low < 0.3962 and 0.4038 < high < 0.405
