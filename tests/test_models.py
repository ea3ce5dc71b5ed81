import random
import threading
import time

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from checks.compare import connect, differences
from checks.oracle import oracle
from checks.queries import REGISTRY
from gradewise.operators import comparison, evaluation, features, training, tuning
from gradewise.operators.comparison import compare_models
from gradewise.operators.sampling import fold_of, hash_split
from gradewise.plans import ExperimentConfig, prepare, run_experiment, run_experiment_file
from gradewise.sources import export_readable, materialize, read_delimited

FEATURES = ["x_100g", "y_100g", "z_100g"]


@pytest.fixture(scope="module")
def learnable(spark):
    """A label that follows x and, less so, y; z is noise; some cells are missing."""
    rng = random.Random(3)
    rows = []
    for k in range(600):
        x, y, z = rng.gauss(0, 1), rng.gauss(0, 1), rng.random()
        label = int(2 * x + y + rng.gauss(0, 0.5) > 0.8)
        rows.append((k, label, None if rng.random() < 0.1 else x, y, z))
    df = spark.createDataFrame(rows, "k int, label int, x_100g double, y_100g double, z_100g double")
    return materialize(df.repartition(4, "k").sortWithinPartitions("k"), "learnable")


@pytest.fixture(scope="module")
def split(learnable):
    return hash_split(learnable, "k")


@pytest.fixture(scope="module")
def stages(split):
    return training.fit_features(split[0], FEATURES)


@pytest.mark.parametrize("make", [training.base_forest, training.boosted_trees, training.logistic])
def test_each_family_learns(split, stages, make):
    model = training.fit_classifier(split[0], stages, make())
    found, scored = evaluation.evaluate(model, split[1], ["k"])
    row = found.first()
    assert row["auc"] > 0.85
    assert row["tp"] + row["tn"] + row["fp"] + row["fn"] == split[1].count() == scored.count()
    assert scored.columns == ["k", "label", "prediction", "raw_score", "score"]


def test_stock_models_have_the_fixed_sizes():
    forest = training.base_forest()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 5, 42)
    assert training.boosted_trees().getMaxIter() == training.logistic().getMaxIter() == 10
    assert training.plain_forest().getNumTrees() == 20


def test_same_seed_and_layout_give_the_same_model(split, stages):
    one, two = (training.fit_classifier(split[0], stages, training.boosted_trees()) for _ in range(2))
    rows = [
        [r["raw_score"] for r in training.score(m, split[1], ["k"]).orderBy("k").collect()] for m in (one, two)
    ]
    assert rows[0] == rows[1]


def test_train_model_splits_when_given_no_split(learnable):
    tree = DecisionTreeClassifier(labelCol="label", seed=1)
    for key in ("k", None):
        trained = training.train_model(learnable, FEATURES, tree, key=key)
        assert trained.train.count() + trained.test.count() == 600
        info = training.training_info(trained.model, trained.train).first()
        assert info == ("DecisionTreeClassificationModel", trained.train.count())


def test_without_a_key_the_layout_does_not_matter(learnable):
    tree = DecisionTreeClassifier(labelCol="label", seed=1)
    keyless = learnable.drop("k")
    parts = [
        sorted(map(str, training.train_model(rows, FEATURES, tree).train.collect()))
        for rows in (keyless, keyless.repartition(7, "y_100g"))
    ]
    assert parts[0] == parts[1] and 0 < len(parts[0]) < 600


def test_at_most_so_many_fits_are_under_way(spark):
    lock, state = threading.Lock(), {"now": 0, "most": 0}

    def work(task):
        with lock:
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
        time.sleep(0.05)
        with lock:
            state["now"] -= 1
        return task * 10

    assert training.in_pool(spark, 3, work, range(12)) == [10 * t for t in range(12)]
    assert state == {"now": 0, "most": 3}
    assert training.in_pool(spark, 3, work, []) == []


def test_candidates_read_stored_vectors_only(learnable, split):
    """Neither imputing nor scaling is done again: the table that is read has no feature columns."""
    train = split[0].withColumn("fold", fold_of("k"))
    vectors = tuning.fold_vectors(train, FEATURES, "label", "fold")
    assert set(vectors.table.columns) == {"label", "fold", "features", *map(tuning.without, range(3))}
    forest = training.plain_forest()
    grid = tuning.forest_grid(forest, (5,), (2, 3))
    nothing = train.sparkSession.createDataFrame([], "label int, fold int")
    given = tuning.cross_validate(nothing, FEATURES, forest, grid, "fold", vectors=vectors)
    own = tuning.cross_validate(train, FEATURES, forest, grid, "fold")
    assert given.report.collect() == own.report.collect() and given.params == own.params


def test_fold_vectors_know_nothing_of_their_fold(spark):
    """The largest value is in fold 0, so without that fold another one scales to 1."""
    rows = [(float(v), v % 2, int(v < 90)) for v in range(100)]
    train = spark.createDataFrame(rows, "x double, label int, fold int")
    vectors = tuning.fold_vectors(train, ["x"], "label", "fold", folds=2).table.collect()
    largest = {name: max(float(r[name][0]) for r in vectors if r["fold"] == 1) for name in ("features", "features_without_0")}
    assert largest["features_without_0"] == 1 and largest["features"] == pytest.approx(89 / 99)


def test_members_are_told_by_bits(spark):
    conditions = [F.col("id") % n == 0 for n in range(1, 63)]
    masks = spark.range(200).select("id", training.subset_mask(conditions).alias("m")).collect()
    assert all((r.m >> i & 1) == (r.id % (i + 1) == 0) for r in masks for i in range(62))


def test_importance_rank(learnable, split, stages):
    model = training.fit_classifier(split[0], stages, training.base_forest())
    rows = evaluation.importance_rank(model, FEATURES, learnable).collect()
    assert [r["rank"] for r in rows] == [1, 2, 3]
    assert [r["feature"] for r in rows] == FEATURES
    assert sum(r["importance"] for r in rows) == pytest.approx(1)
    assert evaluation.importance_rank(model, FEATURES, learnable, top=2).count() == 2


def test_top_features_drop_the_noise(split):
    model = training.fit_on_top_features(split[0], FEATURES, k=2)
    assert model.stages[-2].getIndices() == [0, 1]
    assert model.stages[-1].numFeatures == 2
    assert evaluation.evaluate(model, split[1], ["k"])[0].first()["auc"] > 0.85


def test_ensemble_votes_row_by_row(split):
    ensemble = training.fit_balanced_ensemble(split[0], FEATURES, "k", subsets=3)
    scored = ensemble.score(split[1], ["k"])
    rows = scored.collect()
    assert len(rows) == split[1].count()
    assert all(r["prediction"] == int(r["vote_0"] + r["vote_1"] + r["vote_2"] >= 2) for r in rows)
    assert sum(r["prediction"] == r["label"] for r in rows) / len(rows) > 0.8
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()


def test_grid_is_bound_to_the_tuned_forest(split):
    forest = training.plain_forest()
    assert len(tuning.forest_grid(forest)) == 4
    with pytest.raises(ValueError, match="numTrees"):
        tuning.cross_validate(
            split[0], FEATURES, forest, tuning.forest_grid(RandomForestClassifier()), fold="fold"
        )


def test_cross_validation_tells_candidates_apart(split):
    train = split[0].withColumn("fold", fold_of("k"))
    forest = training.plain_forest()
    tuned = tuning.cross_validate(
        train, FEATURES, forest, tuning.forest_grid(forest, (1, 30), (1, 6)), fold="fold"
    )
    rows = tuned.report.orderBy("candidate").collect()
    assert [(r["numTrees"], r["maxDepth"]) for r in rows] == [(1, 1), (1, 6), (30, 1), (30, 6)]
    assert len({r["mean_auc"] for r in rows}) == 4
    best = max(rows, key=lambda r: r["mean_auc"])
    assert best["is_best"] and sum(r["is_best"] for r in rows) == 1
    assert tuned.params == {"numTrees": best["numTrees"], "maxDepth": best["maxDepth"]}
    assert training.classifier_of(tuned.model).getNumTrees == best["numTrees"]


def test_comparison_has_a_row_per_family(split, stages):
    compared = compare_models(*split, FEATURES, ["k"], prepared=stages)
    rows = compared.report.collect()
    assert [r["model"] for r in rows] == ["Random Forest", "Logistic Regression", "GBT"]
    assert all(r["auc"] > 0.85 for r in rows)


@pytest.fixture(scope="module")
def graded(learnable):
    """Raw table: five grades, a dotted name, an empty column, text to clean."""
    grade = F.when(F.col("k") % 7 == 0, "c").when(F.col("label") == 1, "d").otherwise("a")
    return learnable.select(
        "k",
        grade.alias("nutrition_grade_fr"),
        *FEATURES,
        (F.col("y_100g") * 2).alias("salt.b_100g"),
        F.lit(None).cast("string").alias("empty_100g"),
        F.lit("Glass, Jar").alias("packaging"),
    )


def test_prepare_keeps_all_rows_and_lays_them_out(graded):
    prepared = prepare(graded, ExperimentConfig(key="k", keep=("packaging",)))
    assert prepared.table.count() == 600
    assert prepared.candidates == [*FEATURES, "salt_b_100g", "empty_100g"]
    unlabelled = prepared.table.filter("part = 'unlabelled'")
    assert unlabelled.count() == 86 and unlabelled.filter("x_100g is not null").isEmpty()
    assert prepared.train.count() + prepared.test.count() == prepared.labelled.count() == 514
    assert {r[0] for r in prepared.train.select("fold").distinct().collect()} == {0, 1, 2}
    assert {r[0] for r in prepared.labelled.select("packaging").distinct().collect()} == {"glass jar"}
    plan = prepared.train.filter("fold <> 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_prepare_takes_dotted_names_and_refuses_its_own(graded):
    dotted = graded.withColumnRenamed("nutrition_grade_fr", "grade.fr").withColumnRenamed("k", "row.id")
    prepared = prepare(dotted, ExperimentConfig(grade="grade.fr", key="row.id"))
    assert prepared.key == "row_id" and prepared.labelled.count() == 514
    with pytest.raises(ValueError, match="fold"):
        prepare(graded.withColumnRenamed("k", "fold"), ExperimentConfig(key="fold"))


def test_experiment_reports_every_step(spark, graded, tmp_path):
    output = str(tmp_path / "out")
    config = ExperimentConfig(
        key="k", trees=(5, 10), depths=(2, 3), shown_features=("x_100g", "absent_100g"), output=output
    )
    result = run_experiment(graded, config)
    assert {name for name in result.reports if result.report(name).isEmpty()} <= {"misclassified"}
    reports = {name: result.report(name) for name in result.reports}
    assert result.features == ["y_100g", "z_100g", "salt_b_100g", "x_100g"]
    stats = reports["label_stats"].first()
    assert (stats["discarded"], stats["negatives"] + stats["positives"]) == (86, 514)
    assert {r["variant"] for r in reports["metrics"].collect()} == {"base", "optimised"}
    assert all(r["auc"] > 0.85 for r in reports["metrics"].collect())
    assert reports["tuning"].count() == 4 and reports["importance"].count() == 4
    assert set(result.models) == {"base", "optimised", "Random Forest", "Logistic Regression", "GBT"}
    assert reports["misclassified"].columns == ["k", "label", "prediction", "x_100g"]
    assert reports["misclassified"].count() <= 5
    assert reports["roc"].select("model").distinct().count() == 5
    errors = {r["measure"]: r["base"] for r in reports["base_vs_optimised"].collect()}
    assert errors["Total errors"] == errors["FP"] + errors["FN"]

    dataset = read_delimited(spark, f"{output}/dataset", sep=",")
    assert dataset.count() == 514
    assert dataset.columns == ["k", "label", *[f"{f}_scaled" for f in result.features]]
    written = spark.read.json(f"{output}/metrics")
    assert written.count() == 10 and all(round(r["value"], 4) == r["value"] for r in written.collect())
    assert spark.read.json(f"{output}/importance").count() == 4
    assert spark.read.json(f"{output}/comparison").count() == 3
    assert spark.read.json(f"{output}/base_vs_optimised").count() == 5


def test_experiment_reads_a_file(spark, graded, tmp_path):
    path = str(tmp_path / "products.tsv")
    export_readable(graded, path, sep="\t")
    config = ExperimentConfig(key="k", trees=(3,), depths=(2,))
    result = run_experiment_file(spark, path, config)
    assert result.features == ["y_100g", "z_100g", "salt_b_100g", "x_100g"]
    assert result.report("cleaning_summary").first()["final_row_count"] == 600
    assert result.report("preview").count() == 2 + len(result.features)


def test_rows_without_a_key_are_hashed(graded):
    copies = graded.drop("k").union(graded.drop("k"))
    prepared = prepare(copies, ExperimentConfig())
    assert prepared.key == "row_key" and prepared.table.count() == 1200
    parts = prepared.labelled.groupBy("row_key").agg(F.countDistinct("part").alias("n"))
    assert parts.filter("n > 1").isEmpty()


@pytest.mark.parametrize(
    "name, swapped",
    [
        ("boosted_trees", lambda: training.boosted_trees().setMaxIter(9)),
        ("base_forest", lambda: training.base_forest().setNumTrees(50)),
        ("base_forest", lambda: training.base_forest().setMaxDepth(1)),
        ("logistic", lambda: training.logistic().setMaxIter(1)),
        ("logistic", lambda: training.boosted_trees()),
    ],
)
def test_the_check_on_overlapping_classes_sees_other_models(spark, monkeypatch, name, swapped):
    sf_dir = "/root/testdata/sf0.001"
    other = swapped()
    monkeypatch.setattr(training, name, lambda: other)
    assert differences(spark, connect(sf_dir), sf_dir, REGISTRY["trained_cells"], oracle()["trained_cells"])


def test_fits_read_even_parts_of_few_rows(spark, learnable, monkeypatch):
    rows = spark.range(0, 1000, 1, 1)
    dealt = training.evenly(rows, 10)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 90 and max(sizes) <= 30
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    assert training.evenly(rows, 1000) is rows

    # Rows that one file holds, alike in their content, are dealt out before any fit.
    monkeypatch.setattr(training.evenly, "__defaults__", (20,))
    parts = []
    fit = RandomForestClassifier.fit

    def seen(self, data, *rest):
        parts.append([r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, data, *rest)

    monkeypatch.setattr(RandomForestClassifier, "fit", seen)
    bit = F.col("id") % 2
    one = spark.range(0, 400, 1, 1).select(
        bit.cast("double").alias("x"), bit.cast("int").alias("label"), F.floor(F.col("id") / 2 % 2).cast("int").alias("fold")
    )
    stages = training.fit_features(one, ["x"])
    training.train_model(one, ["x"], training.plain_forest(), split=(one, one), prepared=stages)
    training.fit_on_top_features(one, ["x"], 1, training.plain_forest())
    forest = training.plain_forest()
    tuning.cross_validate(one, ["x"], forest, [{forest.maxDepth: 1}], fold="fold", folds=2)
    assert len(parts) == 6
    assert all(len(p) >= 8 and max(p) <= 60 for p in parts)


def test_ensemble_hashes_a_key_once(spark, split):
    """The keys are read in the pass that stores the vectors, and in no other."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def told(k):
        read.add(1)
        return k

    train = split[0].withColumn("k", told("k"))
    training.fit_balanced_ensemble(train, FEATURES, "k", subsets=2, classifier=RandomForestClassifier(numTrees=1))
    assert read.value == split[0].count()


def test_a_fit_runs_no_shuffle_of_its_rows(spark, monkeypatch):
    """Rows are dealt out once, as files of which a task reads one, and both fits of a selection read the same."""
    plans = []
    fit = RandomForestClassifier.fit

    def seen(self, data, *rest):
        plans.append((data._jdf.queryExecution().executedPlan().toString(), data.inputFiles(), data.rdd.getNumPartitions()))
        return fit(self, data, *rest)

    monkeypatch.setattr(RandomForestClassifier, "fit", seen)
    monkeypatch.setattr(training.evenly, "__defaults__", (20,))
    bit = F.col("id") % 2
    rows = spark.range(0, 400, 1, 1).select(bit.cast("double").alias("x"), bit.cast("int").alias("label"))
    training.fit_on_top_features(rows, ["x"], 1, training.plain_forest())
    training.train_model(rows, ["x"], training.plain_forest(), split=(rows, rows))
    assert not any("Exchange" in plan for plan, _, _ in plans)
    assert [len(files) for _, files, _ in plans] == [n for _, _, n in plans] == [20, 20, 20]
    assert sorted(plans[0][1]) == sorted(plans[1][1])


def test_compared_families_read_the_vectors_as_they_are_stored(spark, monkeypatch):
    """Training rows are written once, in files of which a task reads one, and no family writes them again."""
    made = []
    for module in (training, features):

        def seen(df, name, *rest, write=module.materialize, **options):
            made.append((name, options.get("rows_per_file") or (rest[1] if len(rest) > 1 else None)))
            return write(df, name, *rest, **options)

        monkeypatch.setattr(module, "materialize", seen)
    monkeypatch.setattr(training.evenly, "__defaults__", (20,))
    monkeypatch.setattr(comparison, "ROWS_PER_TASK", 20)
    bit = F.col("id") % 2
    rows = spark.range(0, 400, 1, 1).select("id", bit.cast("double").alias("x"), bit.cast("int").alias("label"))
    compared = compare_models(rows, rows, ["x"], ["id"])
    assert made == [("vectors", 20), ("vectors", None)]
    assert [(r["tp"], r["tn"], r["fp"], r["fn"]) for r in compared.report.collect()] == [(200, 200, 0, 0)] * 3
