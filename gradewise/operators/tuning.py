"""Parameter grid, k-fold cross-validation and its report.

Spark's own cross-validator would refit the feature stages for every candidate and,
given a fold column from Python, check it with a row-at-a-time UDF. Here the feature stages
are fitted once per fold, their vectors are stored in one table, and folds are its folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.operators.evaluation import auc_evaluator
from gradewise.operators.features import MEDIAN_ERROR, store_vectors
from gradewise.operators.training import evenly, fit_features, fit_on_vectors, in_pool

# The grid and the folds.
TREES = (50, 100)
DEPTHS = (5, 10)
FOLDS = 3
PARALLELISM = 2


def forest_grid(forest, trees: Iterable[int] = TREES, depths: Iterable[int] = DEPTHS) -> list[dict]:
    """Trees by depth, bound to the very forest that is tuned."""
    return (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.maxDepth, list(depths))
        .build()
    )


@dataclass
class Tuned:
    """Best model refitted on all training rows, its parameters, and every candidate's score."""

    model: PipelineModel
    params: dict[str, object]
    report: DataFrame


@dataclass
class FoldVectors:
    """Vectors of training rows as all of them, and as those outside each fold, make them; with the stages that do."""

    stages: dict[str, PipelineModel]
    table: DataFrame


def without(fold: int) -> str:
    """Name of the vectors that know nothing of a fold."""
    return f"features_without_{fold}"


def fold_stages(
    train: DataFrame,
    features: list[str],
    fold: str,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    relative_error: float = MEDIAN_ERROR,
) -> dict[str, PipelineModel]:
    """Feature stages fitted on all training rows, ``features``, and on those outside each fold."""
    parts = {"features": train} | {without(i): train.filter(column(fold) != i) for i in range(folds)}
    fitted = in_pool(
        train.sparkSession, parallelism, lambda rows: fit_features(rows, features, relative_error), parts.values()
    )
    return dict(zip(parts, fitted))


def fold_vectors(
    train: DataFrame, features: list[str], label: str, fold: str, folds: int = FOLDS, **options
) -> FoldVectors:
    """Fit the stages and store all vectors of ``train``, laid out by fold."""
    stages = fold_stages(train, features, fold, folds, **options)
    return FoldVectors(stages, store_vectors(train, stages, [label, fold], (fold,)))


def cross_validate(
    train: DataFrame,
    features: list[str],
    classifier: Estimator,
    grid: list[dict],
    fold: str,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    evaluator: Evaluator | None = None,
    relative_error: float = MEDIAN_ERROR,
    vectors: FoldVectors | None = None,
) -> Tuned:
    """Choose the candidate with the best mean AUC over the folds named by column ``fold``.

    All fits, each of a candidate without a fold, share one pool of ``parallelism`` threads,
    so no fold waits for another one's last fit. They read stored vectors, ``vectors`` if they
    are there already; beside those there are no more copies than the fits under way hold.
    """
    foreign = {p.name for params in grid for p in params if p.parent != classifier.uid}
    if foreign:
        raise ValueError(f"grid parameters of another estimator: {sorted(foreign)}")
    label = classifier.getLabelCol()
    evaluator = evaluator or auc_evaluator(label)
    vectors = vectors or fold_vectors(
        train, features, label, fold, folds, parallelism=parallelism, relative_error=relative_error
    )

    def fold_score(task: tuple[int, int]) -> float:
        candidate, held_out = task
        rows = vectors.table.select(column(without(held_out)).alias("features"), label, column(fold))
        model = classifier.copy(grid[candidate]).fit(evenly(rows.filter(column(fold) != held_out).drop(fold)))
        return evaluator.evaluate(model.transform(rows.filter(column(fold) == held_out)))

    # Grids tend to list small models first; begun last they fill what the large ones leave.
    tasks = [(c, i) for c in reversed(range(len(grid))) for i in range(folds)]
    found = dict(zip(tasks, in_pool(train.sparkSession, parallelism, fold_score, tasks)))
    means = [sum(found[c, i] for i in range(folds)) / folds for c in range(len(grid))]
    pick = max if evaluator.isLargerBetter() else min
    best = means.index(pick(means))
    model = fit_on_vectors(vectors.table, vectors.stages["features"], classifier.copy(grid[best]))
    params = {p.name: value for p, value in grid[best].items()}
    return Tuned(model, params, _report(train, grid, means, best))


def _report(df: DataFrame, grid: list[dict], means: list[float], best: int) -> DataFrame:
    """One row per candidate: its parameters (null where it sets none), mean AUC, and if it was chosen."""
    names = list(dict.fromkeys(p.name for params in grid for p in params))
    told = [{p.name: value for p, value in params.items()} for params in grid]
    rows = [
        (i, *[params.get(n) for n in names], mean, i == best) for i, (params, mean) in enumerate(zip(told, means))
    ]
    return df.sparkSession.createDataFrame(rows, ["candidate", *names, "mean_auc", "is_best"]).select(
        F.col("candidate").cast("int").alias("candidate"), *names, "mean_auc", "is_best"
    )
