"""Confusion counts, metrics, exact ROC and AUC, error analysis, importances.

The ROC needs a running total over all scores in order. Scores are first counted per
distinct value, and these counts are stored, so the input is read once. Then the distinct
scores are cut into ranges of about ``SCORES_PER_RANGE`` at sketch quantiles; each range is
ranked in its own task and shifted by the totals of the ranges above it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from gradewise.functions import column
from gradewise.operators.labeling import LABEL
from gradewise.operators.training import classifier_of, score
from gradewise.sources.scratch import materialize

PREDICTION = "prediction"
# Rows in the error listing, features in the importance report.
WRONG_LIMIT = 5
TOP_FEATURES = 10

#: Distinct scores that one task ranks.
SCORES_PER_RANGE = 100_000


def _cells(label: str, prediction: str) -> list[Column]:
    """Counts of the four outcomes; the positive class is 1."""
    is_true, says_true = F.col(label) == 1, F.col(prediction) == 1
    is_false, says_false = F.col(label) == 0, F.col(prediction) == 0
    return [
        F.count_if(is_true & says_true).alias("tp"),
        F.count_if(is_false & says_false).alias("tn"),
        F.count_if(is_false & says_true).alias("fp"),
        F.count_if(is_true & says_false).alias("fn"),
    ]


def _hits(label: str, prediction: str) -> list[Column]:
    """Rows whose prediction is their label, and all rows."""
    return [
        F.count_if(F.col(label) == F.col(prediction)).alias("hits"),
        F.count(F.lit(1)).alias("judged"),
    ]


def confusion(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """``tp, tn, fp, fn`` as one row, in one pass. Rows that are neither 0 nor 1 are in none of them."""
    return df.agg(*_cells(label, prediction))


def _ratio(part: Column, whole: Column) -> Column:
    """Zero where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def with_rates(cells: DataFrame) -> DataFrame:
    """Accuracy and class-1 precision, recall and F1 beside the confusion counts.

    ``hits`` and ``judged`` count all rows, of any classes, and leave the table as accuracy.
    """
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    rates = cells.withColumns(
        {
            "accuracy": _ratio(F.col("hits"), F.col("judged")),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
        }
    )
    precision, recall = F.col("precision"), F.col("recall")
    return rates.drop("hits", "judged").withColumn("f1", _ratio(2 * precision * recall, precision + recall))


def metrics(
    df: DataFrame,
    label: str = LABEL,
    prediction: str = PREDICTION,
    raw_score: str | None = "raw_score",
) -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall, F1, and AUC if scores are given.

    Accuracy takes any number of classes and counts every row; a null label or prediction
    is a miss. The counts, precision, recall, F1 and AUC are about class 1 against class 0.
    """
    counts = [*_cells(label, prediction), *_hits(label, prediction)]
    if raw_score is None:
        return with_rates(df.agg(*counts))
    ranges = _area_by_range(df, label, raw_score, counts)
    return with_rates(_whole_area(ranges, ["tp", "tn", "fp", "fn", "hits", "judged"]))


def area_under_roc(df: DataFrame, label: str = LABEL, score: str = "raw_score") -> DataFrame:
    """Exact area under the ROC curve as one row; null when a class is absent."""
    return _whole_area(_area_by_range(df, label, score, []), []).select("auc")


def auc_evaluator(label: str = LABEL, bins: int = 0) -> BinaryClassificationEvaluator:
    """Spark's evaluator, for model selection; exact unless it is told to merge scores into bins."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=bins
    )


def _score_ranges(df: DataFrame, label: str, score: str, extra: list[Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with the range each score lies in; ``by`` names kinds of scores."""
    scores = df.select(column(score).cast("double").alias("threshold"), "*")
    per_score = materialize(
        scores.groupBy(*by, "threshold").agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) == 0).alias("neg"),
            *extra,
        ),
        "scores",
    )
    # Cut among distinct scores, so that a score which most rows share does not draw the cuts.
    counts = per_score.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per kind
    ranges = []
    ranged = per_score
    for i, row in enumerate(counts):
        parts = math.ceil(row["n"] / SCORES_PER_RANGE)
        own = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in by], F.lit(True))
        steps = [k / parts for k in range(1, parts)]
        cuts = per_score.filter(own).stat.approxQuantile("threshold", steps, 1 / (4 * parts)) if steps else []
        cuts = sorted({c for c in cuts if math.isfinite(c)})
        if not cuts:
            continue
        splits = [float("-inf"), *cuts, float("inf")]
        one = Bucketizer(splits=splits, inputCol=f"__score_{i}", outputCol=f"__range_{i}", handleInvalid="keep")
        ranged = one.transform(ranged.withColumn(f"__score_{i}", F.when(own, F.col("threshold"))))
        ranges.append(F.when(own, F.coalesce(F.col(f"__range_{i}").cast("int"), F.lit(-1))))
    # Never null, so that joins on it add no filter and both sides share one shuffle.
    return ranged.select(*per_score.columns, F.coalesce(*ranges, F.lit(0)).alias("range"))


def _high_to_low(by: tuple[str, ...] = ()):
    return Window.partitionBy(*by, "range").orderBy(F.desc("threshold"))


def _ranges_high_to_low(by: tuple[str, ...] = ()):
    """For tables of ranges only: one row per ``SCORES_PER_RANGE`` distinct scores meets this window."""
    return Window.partitionBy(*by).orderBy(F.desc("range"))


def _sum_above(name: str, window) -> Column:
    above = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(above), F.lit(0).cast("bigint"))


def _area_by_range(df: DataFrame, label: str, score: str, extra: list[Column]) -> DataFrame:
    """Per score range: class counts, other totals, and twice the area its steps add.

    Areas are whole numbers, counted in pairs of one positive and one negative.
    """
    ranged = _score_ranges(df, label, score, extra)
    stepped = ranged.withColumn("pos_above", _sum_above("pos", _high_to_low()))
    exact = "decimal(19,0)"
    step = F.col("neg").cast(exact) * (2 * F.col("pos_above") + F.col("pos")).cast(exact)
    totals = [c for c in ranged.columns if c not in ("threshold", "range")]
    return stepped.groupBy("range").agg(
        *[F.sum(c).alias(c) for c in totals], F.sum(step).alias("area2")
    )


def _whole_area(ranges: DataFrame, totals: list[str]) -> DataFrame:
    """Ranges put together: one row with the totals and the AUC."""
    shifted = ranges.withColumn("pos_above", _sum_above("pos", _ranges_high_to_low()))
    exact = "decimal(19,0)"
    lift = F.col("neg").cast(exact) * (2 * F.col("pos_above")).cast(exact)
    whole = shifted.agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in totals],
        F.sum(F.col("area2") + lift).cast("double").alias("area2"),
        F.sum("pos").cast("double").alias("pos"),
        F.sum("neg").cast("double").alias("neg"),
    )
    auc = F.try_divide(F.col("area2"), 2 * F.col("pos") * F.col("neg"))
    return whole.select(*totals, auc.alias("auc"))


def roc_points(
    df: DataFrame, label: str = LABEL, score: str = "score", drop_collinear: bool = False
) -> DataFrame:
    """``(threshold, fpr, tpr)`` for every distinct score, and the origin at threshold infinity.

    Tied scores make one step. ``drop_collinear`` leaves out points whose neighbours
    count the same positives and negatives, as they do not bend the curve.
    """
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionAll(_points(df, label, score, drop_collinear, ()))


def _points(df: DataFrame, label: str, score: str, drop_collinear: bool, by: tuple[str, ...]) -> DataFrame:
    """The curves' points but their origins, one curve for each value of ``by``."""
    ranged = _score_ranges(df, label, score, [], by)
    # One row per range: 100,000 rows for ten billion distinct scores.
    totals = ranged.groupBy(*by, "range").agg(
        F.sum("pos").alias("range_pos"),
        F.sum("neg").alias("range_neg"),
        F.max_by(F.struct("pos", "neg"), "threshold").alias("first_step"),
    )
    everywhere = Window.partitionBy(*by)
    offsets = totals.select(
        *by,
        "range",
        _sum_above("range_pos", _ranges_high_to_low(by)).alias("pos_offset"),
        _sum_above("range_neg", _ranges_high_to_low(by)).alias("neg_offset"),
        F.sum("range_pos").over(everywhere).alias("all_pos"),
        F.sum("range_neg").over(everywhere).alias("all_neg"),
        F.lead("first_step").over(_ranges_high_to_low(by)).alias("next_range_step"),
    )
    upto = _high_to_low(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = ranged.select(
        *by,
        "range",
        "threshold",
        "pos",
        "neg",
        F.sum("pos").over(upto).alias("pos_upto"),
        F.sum("neg").over(upto).alias("neg_upto"),
        F.lead(F.struct("pos", "neg")).over(_high_to_low(by)).alias("next_step"),
    ).join(F.broadcast(offsets), [*by, "range"])
    if drop_collinear:
        following = F.coalesce("next_step", "next_range_step")
        first = (F.col("pos_upto") + F.col("pos_offset") == F.col("pos")) & (
            F.col("neg_upto") + F.col("neg_offset") == F.col("neg")
        )
        bends = (following["pos"] != F.col("pos")) | (following["neg"] != F.col("neg"))
        steps = steps.filter(first | following.isNull() | bends)
    return steps.select(
        *by,
        "threshold",
        F.try_divide(F.col("neg_upto") + F.col("neg_offset"), "all_neg").alias("fpr"),
        F.try_divide(F.col("pos_upto") + F.col("pos_offset"), "all_pos").alias("tpr"),
    )


def roc_curves(
    scored: dict[str, DataFrame], label: str = LABEL, drop_collinear: bool = False
) -> DataFrame:
    """ROC points of several scored models, ``(model, threshold, fpr, tpr)``.

    All models' scores are counted by one shuffle and ranked by one window.
    """
    every = reduce(
        DataFrame.unionAll,
        [
            df.select(F.lit(name).alias("model"), F.col(label), column("score").cast("double").alias("score"))
            for name, df in scored.items()
        ],
    )
    spark = every.sparkSession
    origins = spark.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in scored])).alias("model"),
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return origins.unionAll(_points(every, label, "score", drop_collinear, ("model",)))


def roc_areas(scored: dict[str, DataFrame], label: str = LABEL) -> DataFrame:
    """Area under each model's curve, ``(model, auc)``."""
    return _stack(scored, "model", lambda df: area_under_roc(df, label, "score"))


def _stack(parts: dict[str, DataFrame], name: str, make) -> DataFrame:
    stacked = None
    for value, df in parts.items():
        part = make(df).select(F.lit(value).alias(name), "*")
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def evaluate(
    model: Model, test: DataFrame, keep: Iterable[str], label: str = LABEL
) -> tuple[DataFrame, DataFrame]:
    """Score the test rows once, store the scores, and compute the metrics from them.

    Returns ``(metrics, scored)``.
    """
    scored = materialize(score(model, test, keep, label), "scored")
    return metrics(scored, label), scored


def label_pairs(df: DataFrame, key: str, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Key, label and prediction, the latter two as integers."""
    return df.select(
        column(key), F.col(label).cast("int").alias(label), F.col(prediction).cast("int").alias(prediction)
    )


def misclassified(
    df: DataFrame,
    key: str,
    columns: Iterable[str] = (),
    limit: int | None = WRONG_LIMIT,
    source: DataFrame | None = None,
    label: str = LABEL,
    prediction: str = PREDICTION,
) -> DataFrame:
    """Wrong rows with the chosen columns, the first ``limit`` by key in order, or all of them.

    Columns that scoring did not carry are fetched from ``source`` by the row key, null
    keys included; they are null where ``source`` lacks the key. It must hold each of the
    wrong rows' keys once at most, so that no row is doubled.
    """
    columns = list(columns)
    wrong = df.filter(F.col(label) != F.col(prediction))
    if limit is not None:
        wrong = wrong.orderBy(column(key)).limit(limit)
    absent = [c for c in columns if c not in df.columns]
    if absent:
        unknown = [c for c in absent if source is None or c not in source.columns]
        if unknown:
            raise ValueError(f"unknown columns: {unknown}")
        # One read of the source: its rows of the keys asked for, counted and stored by key.
        asked = wrong.select(column(key).alias("__asked")).distinct()
        same = F.col("__key").eqNullSafe(F.col("__asked"))
        cells = F.struct(*[column(c) for c in absent])
        fetched = (
            source.select(column(key).alias("__key"), cells.alias("__cells"))
            .join(asked, same, "left_semi")
            .groupBy("__key")
            .agg(F.count(F.lit(1)).alias("__rows"), F.first("__cells").alias("__cells"))
        )
        fetched = materialize(fetched, "looked-up")
        doubled = fetched.filter("__rows > 1").limit(1).collect()
        if doubled:
            raise ValueError(f"the source has several rows of key {doubled[0][0]!r}")
        cells_of = fetched.select("__key", *[F.col("__cells").getField(c).alias(c) for c in absent])
        wrong = wrong.join(cells_of, column(key).eqNullSafe(F.col("__key")), "left")
        if limit is not None:
            wrong = wrong.orderBy(column(key))
    return wrong.select(column(key), label, prediction, *[column(c) for c in columns])


def importance_rank(model: Model, features: list[str], df: DataFrame, top: int | None = None) -> DataFrame:
    """``(rank, feature, importance)``, most important first, ties in feature order.

    One row per feature. Forests and boosted trees have importances, regressions do not.
    """
    importances = classifier_of(model).featureImportances.toArray().tolist()
    order = sorted(range(len(features)), key=lambda i: (-importances[i], i))[:top]
    schema = StructType(
        [
            StructField("rank", IntegerType()),
            StructField("feature", StringType()),
            StructField("importance", DoubleType()),
        ]
    )
    rows = [(n, features[i], importances[i]) for n, i in enumerate(order, start=1)]
    return df.sparkSession.createDataFrame(rows, schema)
