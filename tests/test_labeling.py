from pyspark.sql import functions as F

from gradewise.operators.labeling import assign_label, drop_unlabelled, label_distribution, label_stats


def test_grades_make_labels(products):
    labelled = assign_label(products, "nutrition_grade_fr")
    assert [r["label"] for r in labelled.orderBy("row_id").collect()] == [0, 0, None, 1, 1, None, None]
    assert dict(labelled.dtypes)["label"] == "int"
    assert drop_unlabelled(labelled).count() == 4


def test_stats_count_the_discarded(products, spark):
    labelled = assign_label(products, "nutrition_grade_fr")
    assert label_stats(labelled).first() == (2, 2, 3)
    assert label_stats(spark.createDataFrame([], "label int")).first() == (0, 0, 0)


def test_any_mapping_will_do(products):
    labelled = assign_label(products, "constant_100g", lambda c: F.when(c > 5, 1).otherwise(0))
    assert label_stats(labelled).first() == (0, 7, 0)


def test_distribution_leaves_unlabelled_out(products):
    rows = label_distribution(assign_label(products, "nutrition_grade_fr")).orderBy("label").collect()
    assert [tuple(r) for r in rows] == [(0, 2, 0.5), (1, 2, 0.5)]
