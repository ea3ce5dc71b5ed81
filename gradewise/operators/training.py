"""Classifiers, fitting, batch scoring and the balanced voting ensemble (M2-M8)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.functions import column, majority
from gradewise.operators.cells import TREES_AT_A_TIME, Cells, fit_on_cells
from gradewise.operators.features import MEDIAN_ERROR, feature_stages, store_vectors, top_feature_slicer
from gradewise.operators.labeling import LABEL
from gradewise.operators.sampling import SEED, hash_split, store_subsets, subset_mask  # noqa: F401 (the mask is used from here too)
from gradewise.sources.scratch import materialize

# Sizes of the stock models.
BASE_TREES, BASE_DEPTH = 100, 5
ITERATIONS = 10

#: Training rows in a task: the base forest holds 500 bytes of each in memory, its 100 bootstrap counts included.
ROWS_PER_TASK = 200_000


def base_forest(label: str = LABEL) -> RandomForestClassifier:
    """The default model: 100 trees of depth 5."""
    return RandomForestClassifier(
        labelCol=label, numTrees=BASE_TREES, maxDepth=BASE_DEPTH, seed=SEED
    )


def plain_forest(label: str = LABEL) -> RandomForestClassifier:
    """A forest of library-default size, the one that is tuned and compared."""
    return RandomForestClassifier(labelCol=label, seed=SEED)


def boosted_trees(label: str = LABEL) -> GBTClassifier:
    return GBTClassifier(labelCol=label, maxIter=ITERATIONS, seed=SEED)


def logistic(label: str = LABEL) -> LogisticRegression:
    return LogisticRegression(labelCol=label, maxIter=ITERATIONS)


def stock_classifiers(label: str = LABEL) -> dict[str, Estimator]:
    """The three model families that are compared with each other."""
    return {  # fixed values: their names in reports
        "Random Forest": plain_forest(label),
        "Logistic Regression": logistic(label),
        "GBT": boosted_trees(label),
    }


def fit_features(
    train: DataFrame, features: list[str], relative_error: float = MEDIAN_ERROR
) -> PipelineModel:
    """The feature stages, fitted on training rows.

    Scaling knows of a column no more than its ends, so it is fitted on these as two rows.
    """
    imputer, *later = feature_stages(features, relative_error)
    filled = imputer.fit(train)
    columns = filled.getOutputCols()
    ends = [F.struct(*[end(column(c)).alias(c) for c in columns]) for end in (F.min, F.max)]
    rows = filled.transform(train).agg(F.array(*ends).alias("ends")).select(F.inline("ends"))
    return PipelineModel(stages=[filled, *Pipeline(stages=later).fit(rows).stages])


def fit_classifier(train: DataFrame, prepared: PipelineModel, classifier: Estimator) -> PipelineModel:
    """Fit any classifier behind already fitted feature stages; one model from raw columns."""
    return fit_on_vectors(prepared.transform(train), prepared, classifier)


def fit_on_vectors(
    vectors: DataFrame,
    prepared: PipelineModel,
    classifier: Estimator,
    name: str = "features",
    dealt: bool = False,
    count: Callable[..., Cells | None] | None = None,
) -> PipelineModel:
    """Fit a classifier on vectors that ``prepared`` made; one model from raw columns.

    Trees of many rows are fitted on counts of the rows that they cannot tell apart, if there are few kinds of them.
    ``dealt`` vectors are stored as ``evenly`` does it; ``count`` is ``count_cells`` of them, kept for several fits.
    """
    rows = vectors.select(column(name).alias("features"), classifier.getLabelCol())

    def pool(work: Callable, tasks: Iterable) -> list:
        return in_pool(vectors.sparkSession, TREES_AT_A_TIME, work, tasks)

    model = fit_on_cells(rows, classifier, pool, count)
    if model is None:
        model = classifier.fit(rows if dealt else evenly(rows))
    return PipelineModel(stages=[*prepared.stages, model])


def evenly(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` stored for a fit that reads them by tasks of at most ``rows_per_task``; fewer rows in all stay as they are.

    Splits of stored tables go by compressed bytes, and a fit holds rows unpacked: 128 MB of
    vectors with few distinct values are tens of millions. A fit reads its rows several
    times, and asks for their partitions, which would run a shuffle each time.
    """
    return rows if rows.count() <= rows_per_task else materialize(rows, "dealt", rows_per_file=rows_per_task)


def in_pool(spark: SparkSession, parallelism: int, work: Callable, tasks: Iterable) -> list:
    """Results of ``work`` for each task, in their order, with at most ``parallelism`` of them under way."""
    tasks = list(tasks)
    if not tasks:
        return []
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), tasks, chunksize=1)


@dataclass
class Trained:
    model: PipelineModel
    train: DataFrame
    test: DataFrame


def train_model(
    df: DataFrame,
    features: list[str],
    classifier: Estimator | None = None,
    key: str | None = None,
    split: tuple[DataFrame, DataFrame] | None = None,
    relative_error: float = MEDIAN_ERROR,
    prepared: PipelineModel | None = None,
) -> Trained:
    """Fit the base forest or the given classifier; split first when no split is given.

    The split hashes the ``key``, or the rows' content where there is none. ``prepared``:
    the feature stages where they are fitted on the training rows already.
    """
    if split is None:
        split = hash_split(df, key)
    train, test = split
    prepared = prepared or fit_features(train, features, relative_error)
    return Trained(fit_classifier(train, prepared, classifier or base_forest()), train, test)


def training_info(model: PipelineModel, train: DataFrame) -> DataFrame:
    """Model type and number of training rows, as one row."""
    return train.agg(F.count(F.lit(1)).alias("training_rows")).select(
        F.lit(classifier_of(model).__class__.__name__).alias("model_type"), "training_rows"
    )


def classifier_of(model: Model) -> Model:
    """The last stage of a pipeline, or the model itself."""
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def score(model: Model, df: DataFrame, keep: Iterable[str], label: str = LABEL) -> DataFrame:
    """Prediction and class-1 scores beside the carried columns; every row is kept.

    ``raw_score`` comes from ``rawPrediction`` and ``score`` from ``probability``, or
    from ``rawPrediction`` too when the classifier gives no probability.
    """
    carried = dict.fromkeys([*keep, label])
    predicted = model.transform(df)
    probability = "probability" if "probability" in predicted.columns else "rawPrediction"
    return predicted.select(
        *[column(c) for c in carried],
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("rawPrediction")[1].alias("raw_score"),
        vector_to_array(probability)[1].alias("score"),
    )


def fit_on_top_features(
    train: DataFrame,
    features: list[str],
    k: int,
    classifier: Estimator | None = None,
    relative_error: float = MEDIAN_ERROR,
) -> PipelineModel:
    """Rank features with the base forest, keep the ``k`` best, fit the classifier on those."""
    prepared = fit_features(train, features, relative_error)
    forest, classifier = base_forest(), (classifier or base_forest()).copy()
    labels = dict.fromkeys([forest.getLabelCol(), classifier.getLabelCol()])
    vectors = evenly(prepared.transform(train).select("features", *labels))  # the same ones for both fits
    slicer = top_feature_slicer(forest.fit(vectors).featureImportances.toArray(), k)
    classifier.setFeaturesCol(slicer.getOutputCol())
    top = slicer.transform(vectors).select(slicer.getOutputCol(), classifier.getLabelCol())
    return PipelineModel(stages=[*prepared.stages, slicer, classifier.fit(top)])


@dataclass
class VotingEnsemble:
    """Classifiers trained on balanced subsets, behind shared feature stages."""

    prepared: PipelineModel
    members: list[Model]

    def score(self, df: DataFrame, keep: Iterable[str], label: str = LABEL) -> DataFrame:
        """Each member's vote and the majority, row by row: no join and no shuffle."""
        carried = list(dict.fromkeys([*keep, label]))
        scored = self.prepared.transform(df).select(*[column(c) for c in carried], "features")
        votes = [f"vote_{i}" for i in range(len(self.members))]
        for vote, member in zip(votes, self.members):
            # An empty name tells the model to leave that output out.
            names = {"predictionCol": vote, "rawPredictionCol": "", "probabilityCol": ""}
            params = {member.getParam(p): name for p, name in names.items() if member.hasParam(p)}
            scored = member.transform(scored, params)
        return scored.select(
            *[column(c) for c in carried],
            *[F.col(v).cast("int").alias(v) for v in votes],
            majority([F.col(v) for v in votes]).alias("prediction"),
        )


def fit_balanced_ensemble(
    train: DataFrame,
    features: list[str],
    key: str,
    subsets: int = 5,
    classifier: Estimator | None = None,
    label: str = LABEL,
    relative_error: float = MEDIAN_ERROR,
    parallelism: int = 2,
) -> VotingEnsemble:
    """One classifier per class-balanced subset, ``parallelism`` of them fitted at a time.

    Vectors are stored once, with bits of a mask and hashes near a cut that tell the subsets of
    a row, so a member reads its rows by a filter.
    """
    classifier = classifier or plain_forest(label)
    prepared = fit_features(train, features, relative_error)

    def store(rows: DataFrame, told: list[str]) -> DataFrame:
        return store_vectors(rows, {"features": prepared}, [label, *told], rows_per_file=ROWS_PER_TASK)

    vectors, conditions = store_subsets(train, key, store, label, subsets)

    def member(condition: Column) -> Model:
        return classifier.copy().fit(vectors.filter(condition).select("features", classifier.getLabelCol()))

    return VotingEnsemble(prepared, in_pool(train.sparkSession, parallelism, member, conditions))
