import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from gradewise.operators import evaluation
from gradewise.operators.comparison import compare_confusions
from gradewise.operators.evaluation import (
    area_under_roc,
    confusion,
    label_pairs,
    metrics,
    misclassified,
    roc_areas,
    roc_curves,
    roc_points,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "key int, label int, prediction int, raw_score double, score double")


def judged(spark, n=600, seed=1, levels=None, hot=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        label = int(rng.random() < 0.4)
        value = rng.random() + 0.3 * label
        if levels:
            value = round(value * levels) / levels
        if hot and rng.random() < 0.4:
            value = 0.5
        rows.append((k, label, int(value > 0.6), value, value))
    return rows


def brute_roc(rows, corners=False):
    """Curve by walking down the distinct scores."""
    pos, neg = sum(r[1] for r in rows), sum(1 - r[1] for r in rows)
    steps = []
    for score in sorted({r[4] for r in rows}, reverse=True):
        labels = [r[1] for r in rows if r[4] == score]
        steps.append((score, sum(labels), len(labels) - sum(labels)))
    points, tp, fp = [], 0, 0
    for i, (score, p, n) in enumerate(steps):
        tp, fp = tp + p, fp + n
        inner = 0 < i < len(steps) - 1
        if not (corners and inner and steps[i + 1][1:] == (p, n)):
            points.append((score, fp / neg, tp / pos))
    return [(float("inf"), 0.0, 0.0), *points]


SHAPES = {
    "distinct": {},
    "tied": {"levels": 7},
    "hot": {"hot": True},
    "binary": {"levels": 1},
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("parts", ["1", "8", "50"])
def test_roc_equals_brute_force(spark, with_conf, shape, parts):
    with_conf(spark__sql__shuffle__partitions=parts)
    rows = judged(spark, **SHAPES[shape])
    df = frame(spark, rows).repartition(5)
    for corners in (False, True):
        found = sorted((tuple(r) for r in roc_points(df, drop_collinear=corners).collect()), reverse=True)
        assert found == brute_roc(rows, corners)
    area = area_under_roc(df).first()["auc"]
    exact = BinaryClassificationEvaluator(rawPredictionCol="raw_score", numBins=0).evaluate(df)
    assert area == pytest.approx(exact, abs=1e-12)
    points = brute_roc(rows)
    trapezoids = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(trapezoids, abs=1e-12)


def test_infinite_scores_are_ranked(spark):
    inf = float("inf")
    rows = [(0, 1, 1, inf, 0.0), (1, 1, 1, 2.0, 0.0), (2, 0, 0, -inf, 0.0), (3, 0, 0, 2.0, 0.0)]
    assert area_under_roc(frame(spark, rows)).first()["auc"] == 0.875


def test_one_class_has_no_area(spark):
    df = frame(spark, [(1, 1, 1, 0.5, 0.5), (2, 1, 0, 0.4, 0.4)])
    assert area_under_roc(df).first()["auc"] is None
    row = metrics(df).first()
    assert (row["tp"], row["fn"], row["accuracy"], row["auc"]) == (1, 1, 0.5, None)
    assert {r["fpr"] for r in roc_points(df).collect()} == {0.0, None}


def test_metrics_of_class_one(spark):
    rows = [(i, *pair, 0.0, 0.0) for i, pair in enumerate([(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 3)]
    row = metrics(frame(spark, rows)).first()
    assert (row["tp"], row["tn"], row["fp"], row["fn"]) == (6, 3, 1, 2)
    assert row["accuracy"] == 9 / 12
    assert (row["precision"], row["recall"]) == (6 / 7, 6 / 8)
    assert row["f1"] == pytest.approx(2 * 6 / (2 * 6 + 1 + 2))
    assert row["auc"] == 0.5
    without = metrics(frame(spark, rows), raw_score=None)
    assert "auc" not in without.columns and without.first()["tp"] == 6


def test_zero_denominators_give_zero(spark):
    for df in (frame(spark, []), frame(spark, [(1, 0, 0, 0.1, 0.1)])):
        row = metrics(df).first()
        assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    empty = metrics(frame(spark, [])).first()
    assert (empty["tp"], empty["accuracy"], empty["auc"]) == (0, 0.0, None)


def test_confusion_is_one_pass(spark):
    plan = confusion(frame(spark, judged(spark, 10)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_label_pairs_are_integers(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0)], "key int, label double, prediction double")
    assert label_pairs(df, "key").dtypes == [("key", "int"), ("label", "int"), ("prediction", "int")]


def test_misclassified_rows_carry_or_fetch_columns(spark):
    df = frame(spark, [(1, 1, 0, 0.1, 0.1), (2, 0, 0, 0.2, 0.2), (3, 0, 1, 0.3, 0.3), (4, 1, 0, 0.3, 0.3)])
    source = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "x")], "key int, name string")
    assert [r["key"] for r in misclassified(df, "key", limit=2).orderBy("key").collect()] == [1, 3]
    fetched = misclassified(df, "key", ["score", "name"], limit=None, source=source)
    assert sorted(tuple(r) for r in fetched.collect()) == [(1, 1, 0, 0.1, "x"), (3, 0, 1, 0.3, "x"), (4, 1, 0, 0.3, "x")]
    with pytest.raises(ValueError, match="nothing"):
        misclassified(df, "key", ["nothing"], source=source)


def test_two_versions_side_by_side(spark):
    base = frame(spark, [(1, 1, 0, 0.0, 0.0), (2, 0, 0, 0.0, 0.0)])
    optimised = frame(spark, [(1, 1, 1, 0.0, 0.0), (2, 0, 1, 0.0, 0.0)])
    rows = compare_confusions(confusion(base), confusion(optimised)).orderBy("position").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("TP", 0, 1),
        ("TN", 1, 0),
        ("FP", 0, 1),
        ("FN", 1, 0),
        ("Total errors", 1, 1),
    ]


def test_curves_of_several_models(spark):
    scored = {"one": frame(spark, judged(spark, 50)), "two": frame(spark, judged(spark, 60, seed=2))}
    curves = roc_curves(scored)
    assert {r["model"] for r in curves.select("model").distinct().collect()} == {"one", "two"}
    areas = {r["model"]: r["auc"] for r in roc_areas(scored).collect()}
    assert areas["two"] == area_under_roc(scored["two"]).first()["auc"]


def test_accuracy_counts_every_row(spark):
    def accuracy(rows):
        df = spark.createDataFrame(rows, "label int, prediction int, raw_score double")
        found = metrics(df).first()["accuracy"]
        assert metrics(df, raw_score=None).first()["accuracy"] == found
        assert "hits" not in metrics(df).columns
        return found

    assert accuracy([(0, 0, 0.1), (1, 1, 0.9), (2, 2, 0.5), (2, 0, 0.2), (1, 2, 0.7)]) == 0.6
    assert accuracy([(0, 0, 0.1), (1, 1, 0.9), (1, None, 0.5)]) == pytest.approx(2 / 3)
    assert accuracy([(None, 1, 0.1), (1, 1, 0.9)]) == 0.5


def test_ranges_hold_few_distinct_scores(spark, monkeypatch):
    """99 % of the rows share a score."""
    monkeypatch.setattr(evaluation, "SCORES_PER_RANGE", 500)
    rows = [(i, i % 2, 0, 0.5 if i % 100 else i / 4e5, 0.0) for i in range(400_000)]
    df = frame(spark, rows).repartition(8)
    ranged = evaluation._score_ranges(df, "label", "raw_score", [])
    sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) <= 3 * 4_000 / 8
    exact = BinaryClassificationEvaluator(rawPredictionCol="raw_score", numBins=0).evaluate(df)
    assert area_under_roc(df).first()["auc"] == pytest.approx(exact, abs=1e-12)


def test_looked_up_columns_lose_and_double_no_row(spark):
    df = frame(spark, [(1, 1, 0, 0.1, 0.1), (None, 0, 1, 0.2, 0.2), (3, 0, 1, 0.3, 0.3), (4, 1, 1, 0.3, 0.3)])
    source = spark.createDataFrame([(1, "x"), (None, "n"), (4, "y"), (4, "z")], "key int, name string")
    for limit in (None, 5):
        found = misclassified(df, "key", ["name"], limit=limit, source=source).collect()
        assert sorted((str(r["key"]), str(r["name"])) for r in found) == [("1", "x"), ("3", "None"), ("None", "n")]
    ordered = misclassified(df, "key", ["name"], limit=2, source=source).collect()
    assert [(r["key"], r["name"]) for r in ordered] == [(None, "n"), (1, "x")]
    doubled = source.union(spark.createDataFrame([(1, "again")], "key int, name string"))
    with pytest.raises(ValueError, match="several rows"):
        misclassified(df, "key", ["name"], source=doubled)


def test_curves_of_several_models_are_those_of_each(spark, monkeypatch):
    """Models of many and of few distinct scores, of one class, and without rows; null and NaN scores."""
    monkeypatch.setattr(evaluation, "SCORES_PER_RANGE", 40)
    nan = float("nan")
    rows = {
        "many": [(k, k % 3 % 2, 0, 0.0, (k * 37 % 500) / 500) for k in range(700)] + [(9, 1, 0, 0.0, None), (8, 0, 0, 0.0, nan)],
        "few": [(k, k % 2, 0, 0.0, float(k % 7)) for k in range(100)],
        "one class": [(k, 1, 0, 0.0, k / 90) for k in range(90)],
        "none": [],
    }
    scored = {name: frame(spark, r) for name, r in rows.items()}
    for drop in (False, True):
        found = {}
        for r in roc_curves(scored, drop_collinear=drop).collect():
            found.setdefault(r["model"], []).append((str(r["threshold"]), r["fpr"], r["tpr"]))
        assert set(found) == set(rows)
        for name, df in scored.items():
            alone = [(str(r[0]), r[1], r[2]) for r in roc_points(df, drop_collinear=drop).collect()]
            assert sorted(found[name], key=str) == sorted(alone, key=str)


def test_scores_of_all_models_take_one_shuffle(spark, monkeypatch):
    made = []
    monkeypatch.setattr(evaluation, "materialize", lambda df, name: made.append(df) or df)
    roc_curves({name: frame(spark, judged(spark, seed=i)) for i, name in enumerate("abcd")})
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert len(made) == 1 and plan.count("Exchange hashpartitioning") == 1


def test_a_lookup_reads_its_source_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = frame(spark, [(k, 1, k % 2, 0.1, 0.1) for k in range(50)])
    source = spark.range(1000).selectExpr("cast(id as int) key", "concat('n', id) name")
    source = source.mapInPandas(counted, "key int, name string")
    rows = misclassified(df, "key", ["name"], limit=None, source=source).collect()
    assert sorted((r["key"], r["name"]) for r in rows) == [(k, f"n{k}") for k in range(0, 50, 2)]
    assert read.value == 1000
