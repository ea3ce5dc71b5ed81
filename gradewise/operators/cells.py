"""Tree fits on counted rows (M2): what a fit cannot tell apart is counted once, and the counts are fitted.

Spark's trees see of a row its label and, of each feature, one of ``maxBins`` bins. So the bins of all
features make a number of cells that no table exceeds, and one pass counts the rows of each cell and
label. Boosting takes a count as the weight of one row. A forest's bootstrap draws a Poisson
number of mean 1 for each row and tree; over ``n`` rows alike these add up to one of mean ``n``,
which is drawn for the cell. Features that make too many cells leave the fit to the rows themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gradewise.functions import column
from gradewise.sources.scratch import materialize

#: Fewer training rows than these are fitted sooner by themselves than the trees of a forest one by one.
LEAST_ROWS = 1_000_000
#: Cells that the driver holds, for each tree a number.
MAX_CELLS = 1 << 15
#: Spark's own number of rows that it seeks splits among, at least.
SPLIT_ROWS = 10_000
#: Trees of a forest that are fitted at a time.
TREES_AT_A_TIME = 8


@dataclass
class Cells:
    """By feature the bins, each the least and greatest value seen of it, and the rows of each cell and label."""

    cuts: list[list[list[float]]]
    counted: list[Row]


def count_cells(vectors: DataFrame, features: str, label: str, max_bins: int, seed: int) -> Cells | None:
    """Rows of each cell and label; null if they are few, or too many cells, or hold what a fit reports as an error."""
    n_rows = vectors.count()
    if n_rows < LEAST_ROWS:
        return None
    values = vectors.select(vector_to_array(column(features)).alias("values"), column(label).alias("label"))
    cuts = _cuts(values, max_bins, seed, n_rows)
    if cuts is None:
        return None
    counted = values.select(_cell(cuts).alias("cell"), "label").groupBy("cell", "label").agg(F.count(F.lit(1)).alias("n"))
    found = counted.limit(2 * MAX_CELLS + 1).collect()
    # Missing labels and entries that are no finite numbers are errors, which the fit on rows reports.
    if len(found) > 2 * MAX_CELLS or any(r["cell"] is None or r["label"] is None for r in found):
        return None
    return Cells(cuts, sorted(found, key=lambda r: (r["cell"], r["label"])))


def fit_on_cells(
    rows: DataFrame, classifier: Estimator, pool: Callable, count: Callable[..., Cells | None] | None = None
) -> Model | None:
    """The trees that ``classifier`` makes of vectors and labels, or null where it must have the rows.

    ``pool(work, tasks)`` runs the fits of single trees. ``count`` is ``count_cells`` of the same
    rows, for several classifiers that share what it found.
    """
    if not _takes_counts(rows, classifier):
        return None
    features, label = classifier.getFeaturesCol(), classifier.getLabelCol()
    count = count or partial(count_cells, rows)
    cells = count(features, label, classifier.getMaxBins(), classifier.getSeed())
    if cells is None:
        return None
    cuts, found = cells.cuts, cells.counted
    labels = [float(r["label"]) for r in found]
    counts = np.array([r["n"] for r in found])
    points = _points([r["cell"] for r in found], cuts)
    spare = _spare_points(cuts)  # of no weight
    points, labels = points + spare, labels + labels[:1] * len(spare)
    weights = _weights(counts, classifier)
    weights = np.hstack([weights, np.zeros((len(weights), len(spare)))])
    names = [f"weight_{i}" for i in range(len(weights))]
    table = pa.table(
        {"values": pa.array(points, pa.list_(pa.float64())), "label": pa.array(labels, pa.float64())}
        | {name: pa.array(w, pa.float64()) for name, w in zip(names, weights)}
    )
    made = rows.sparkSession.createDataFrame(table).coalesce(1).select(
        array_to_vector("values").alias(features),
        F.col("label").alias(label, metadata=rows.schema[label].metadata),
        *names,
    )
    weighted = materialize(made, "cells")
    # Every point is looked at for splits, and each gap between two points may be one.
    bins = max(2 * classifier.getMaxBins(), math.ceil(math.sqrt(len(points))))
    changed = {classifier.maxBins: bins}
    if isinstance(classifier, GBTClassifier):
        model = classifier.copy({**changed, classifier.weightCol: names[0]}).fit(weighted)
        for name in ("maxBins", "weightCol"):
            model.clear(model.getParam(name))
        return _with_params(classifier, model)
    changed |= {classifier.numTrees: 1, classifier.bootstrap: False, classifier.featureSubsetStrategy: _subset(classifier)}

    def tree(i: int) -> RandomForestClassificationModel:
        own = {classifier.weightCol: names[i], classifier.seed: classifier.getSeed() + i}
        return classifier.copy({**changed, **own}).fit(weighted.select(column(features), column(label), names[i]))

    return _forest(rows.sparkSession.sparkContext, classifier, pool(tree, range(len(names))))


def _takes_counts(rows: DataFrame, classifier: Estimator) -> bool:
    """Can the classifier be fitted on counts? Not if it tells rows apart, samples them itself or sees categories."""
    if type(classifier) not in (RandomForestClassifier, GBTClassifier):
        return False
    told_apart = ("weightCol", "validationIndicatorCol")
    attributes = rows.schema[classifier.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (
        isinstance(rows.schema[classifier.getLabelCol()].dataType, NumericType)
        and not any(classifier.hasParam(p) and classifier.isDefined(p) and classifier.getOrDefault(p) for p in told_apart)
        and classifier.getMinInstancesPerNode() == 1
        and classifier.getMinWeightFractionPerNode() == 0
        and classifier.getSubsamplingRate() == 1
        and not {"nominal", "binary"} & set(attributes)
    )


def _cuts(values: DataFrame, max_bins: int, seed: int, n_rows: int) -> list[list[list[float]]] | None:
    """By feature its bins, low to high; null for too many cells.

    Bins are Spark's own: it seeks splits among some rows, takes all values apart where bins suffice,
    and else about as many rows to a bin. A split is midway between two neighbouring values.
    """
    share = max(max_bins**2, SPLIT_ROWS) / n_rows
    seen = values.sample(share, seed) if share < 1 else values
    width = values.select(F.size("values")).first()[0]
    if not width or width > math.log2(MAX_CELLS):  # of two bins each they make too many
        return None
    every = seen.select(F.posexplode("values").alias("feature", "value")).groupBy("feature", "value").count().collect()
    cuts = []
    for feature in range(width):
        counts = sorted((r["value"], r["count"]) for r in every if r["feature"] == feature)
        if not counts or any(v is None or not math.isfinite(v) for v, _ in counts):
            return None
        cuts.append(_bins(counts, max_bins))
    return cuts if math.prod(len(bins) for bins in cuts) <= MAX_CELLS else None


def _bins(counts: list[tuple[float, int]], max_bins: int) -> list[list[float]]:
    """Values cut as ``RandomForest.findSplitsForContinuousFeature`` cuts them: least and greatest of each bin."""
    if len(counts) <= max_bins:
        return [[v, v] for v, _ in counts]
    stride = sum(n for _, n in counts) / max_bins
    bins, upto, target = [[counts[0][0]] * 2], counts[0][1], stride
    for value, n in counts[1:]:
        before, upto = upto, upto + n
        if abs(before - target) < abs(upto - target):
            bins.append([value, value])
            target += stride
        bins[-1][1] = value
    return bins


def _splits(bins: list[list[float]]) -> list[float]:
    return [(low[1] + high[0]) / 2 for low, high in pairwise(bins)]


def _cell(cuts: list[list[list[float]]]) -> Column:
    """Number of the row's cell, its digits the bins; null where an entry is no finite number."""
    cell, finite = F.lit(0), F.lit(True)
    for feature, bins in enumerate(cuts):
        value = F.col("values")[feature]
        above = reduce(lambda a, b: a + b, [(value > s).cast("int") for s in _splits(bins)], F.lit(0))
        cell, finite = cell * len(bins) + above, finite & (F.abs(value) < float("inf"))
    return F.when(finite, cell)


def _points(cells: list[int], cuts: list[list[list[float]]]) -> list[list[float]]:
    """A vector of each cell: the greatest value seen of every bin."""
    points = []
    for cell in cells:
        point = []
        for bins in reversed(cuts):
            cell, digit = divmod(cell, len(bins))
            point.append(bins[digit][1])
        points.append(point[::-1])
    return points


def _spare_points(cuts: list[list[list[float]]]) -> list[list[float]]:
    """The least values of bins of several, so that the split midway to the bin below stays where it is."""
    least = [[low for low, high in bins if low < high] for bins in cuts]
    return [
        [values[i] if i < len(values) else bins[0][1] for values, bins in zip(least, cuts)]
        for i in range(max(map(len, least)))
    ]


def _weights(counts: np.ndarray, classifier: Estimator) -> np.ndarray:
    """By tree the rows of each cell that it learns from."""
    if isinstance(classifier, GBTClassifier):
        return counts[None, :].astype(float)
    if not classifier.getBootstrap():
        return np.tile(counts.astype(float), (classifier.getNumTrees(), 1))
    draw = np.random.default_rng(classifier.getSeed() % 2**64)
    return draw.poisson(counts, (classifier.getNumTrees(), len(counts))).astype(float)


def _subset(classifier: RandomForestClassifier) -> str:
    """The features that a forest's node may split, told to a tree by itself."""
    strategy = classifier.getFeatureSubsetStrategy()
    return "sqrt" if strategy == "auto" and classifier.getNumTrees() > 1 else strategy


def _forest(
    context: SparkContext, classifier: RandomForestClassifier, found: list[RandomForestClassificationModel]
) -> Model:
    """One forest of the only trees of several; there is no Python name for making it."""
    classes = context._jvm.org.apache.spark.ml.classification
    trees = context._gateway.new_array(classes.DecisionTreeClassificationModel, len(found))
    for i, model in enumerate(found):
        trees[i] = model.trees[0]._java_obj
    made = classes.RandomForestClassificationModel(classifier.uid, trees, found[0].numFeatures, found[0].numClasses)
    return _with_params(classifier, RandomForestClassificationModel._from_java(made))


def _with_params(classifier: Estimator, model: Model) -> Model:
    """The model with the parameters that ``classifier`` was given, as after its own fit."""
    model = classifier._copyValues(model)
    model._transfer_params_to_java()
    return model
