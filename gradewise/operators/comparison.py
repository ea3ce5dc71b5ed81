"""Compare model families on one split, and two versions of one model."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache, partial, reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.operators.cells import count_cells
from gradewise.operators.evaluation import evaluate
from gradewise.operators.features import MEDIAN_ERROR, store_vectors
from gradewise.operators.labeling import LABEL
from gradewise.operators.training import (
    ROWS_PER_TASK,
    classifier_of,
    fit_features,
    fit_on_vectors,
    in_pool,
    stock_classifiers,
)
from gradewise.sources.reports import BASE, OPTIMISED

# Measures of the base-optimised comparison, in report order.
MEASURES = ("TP", "TN", "FP", "FN", "Total errors")


@dataclass
class Compared:
    report: DataFrame
    models: dict[str, PipelineModel]
    scored: dict[str, DataFrame]


def fit_and_evaluate(
    vectors: tuple[DataFrame, DataFrame],
    prepared: PipelineModel,
    classifiers: dict[str, Estimator],
    keep: Iterable[str],
    label: str = LABEL,
    parallelism: int = 2,
    dealt: bool = False,
) -> dict[str, tuple[PipelineModel, DataFrame, DataFrame]]:
    """By name the model, its metrics and the scored test rows; ``parallelism`` models at a time.

    ``vectors`` are stored training and test rows with the ``features`` that ``prepared`` makes;
    ``dealt`` ones have their training rows in files of ``ROWS_PER_TASK``.
    """
    train, test = vectors
    count = cache(partial(count_cells, train))  # the same cells for all families of trees

    def one(classifier: Estimator) -> tuple[PipelineModel, DataFrame, DataFrame]:
        model = fit_on_vectors(train, prepared, classifier, dealt=dealt, count=count)
        return model, *evaluate(classifier_of(model), test, keep, label)

    found = in_pool(train.sparkSession, parallelism, one, classifiers.values())
    return dict(zip(classifiers, found))


def compared(found: dict[str, tuple[PipelineModel, DataFrame, DataFrame]]) -> Compared:
    """The report of models that were fitted on the same rows, a row each."""
    rows = [metrics.select(F.lit(name).alias("model"), "*") for name, (_, metrics, _) in found.items()]
    return Compared(
        reduce(DataFrame.unionByName, rows),
        {name: model for name, (model, _, _) in found.items()},
        {name: scored for name, (_, _, scored) in found.items()},
    )


def compare_models(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    keep: Iterable[str],
    classifiers: dict[str, Estimator] | None = None,
    label: str = LABEL,
    prepared: PipelineModel | None = None,
    relative_error: float = MEDIAN_ERROR,
    parallelism: int = 2,
) -> Compared:
    """Fit and evaluate each classifier on the same rows behind the same feature stages.

    Both parts' vectors are stored, once for all classifiers and as their fits read them.
    """
    keep = list(keep)
    prepared = prepared or fit_features(train, features, relative_error)
    stages, kept = {"features": prepared}, [*keep, label]
    vectors = store_vectors(train, stages, kept, rows_per_file=ROWS_PER_TASK), store_vectors(test, stages, kept)
    classifiers = classifiers or stock_classifiers(label)
    return compared(fit_and_evaluate(vectors, prepared, classifiers, keep, label, parallelism, dealt=True))


def compare_confusions(base: DataFrame, optimised: DataFrame) -> DataFrame:
    """Two one-row confusion tables side by side: ``(position, measure, base, optimised)``."""
    both = base.select(F.lit(BASE).alias("variant"), "tp", "tn", "fp", "fn").unionByName(
        optimised.select(F.lit(OPTIMISED).alias("variant"), "tp", "tn", "fp", "fn")
    )
    values = [F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"), F.col("fp") + F.col("fn")]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(m).alias("measure"), v.alias("value"))
            for i, (m, v) in enumerate(zip(MEASURES, values), start=1)
        ]
    )
    long = both.select("variant", F.inline(rows))
    return long.groupBy("position", "measure").pivot("variant", [BASE, OPTIMISED]).agg(F.first("value"))
