"""Impute, assemble, scale, unpack and select features.

Everything that learns from data is an unfitted pipeline stage, so it is fitted on
the training rows it belongs to and on nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    MinMaxScaler,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.operators.medians import ExactMedianImputer
from gradewise.sources.scratch import materialize

# Spark's own default error of the median sketch; 0 means exact.
MEDIAN_ERROR = 0.001


def imputed(name: str) -> str:
    return f"{name}_imputed"


def scaled(name: str) -> str:
    return f"{name}_scaled"


def median_imputer(features: list[str], relative_error: float = MEDIAN_ERROR) -> Estimator:
    """Fill null and NaN with the column's lower median, in new ``*_imputed`` columns."""
    outputs = [imputed(f) for f in features]
    if relative_error == 0:
        return ExactMedianImputer(inputCols=features, outputCols=outputs)
    return Imputer(
        strategy="median", inputCols=features, outputCols=outputs, relativeError=relative_error
    )


def feature_stages(features: list[str], relative_error: float = MEDIAN_ERROR) -> list:
    """Unfitted stages from raw feature columns to the scaled ``features`` vector."""
    if not features:
        raise ValueError("no features")
    dotted = [f for f in features if "." in f]
    if dotted:
        raise ValueError(f"rename dotted feature columns first (without_dots): {dotted}")
    return [
        median_imputer(features, relative_error),
        VectorAssembler(
            inputCols=[imputed(f) for f in features],
            outputCol="unscaled_features",
            handleInvalid="error",
        ),
        MinMaxScaler(inputCol="unscaled_features", outputCol="features"),
    ]


def store_vectors(
    df: DataFrame,
    stages: Mapping[str, PipelineModel],
    keep: Iterable[str],
    partition_by: tuple[str, ...] = (),
    rows_per_file: int | None = None,
) -> DataFrame:
    """Written table of the columns ``keep`` and one vector column per fitted set of stages, named as it is in ``stages``.

    All sets run in one pass over ``df``; whatever learns from the vectors then reads one
    column, without imputing or scaling again.
    """
    keep, vectors = list(dict.fromkeys(keep)), df
    for i, model in enumerate(stages.values()):
        made = model.transform(vectors)
        vectors = made.select(*[column(c) for c in vectors.columns], F.col("features").alias(f"__vector_{i}"))
    named = [F.col(f"__vector_{i}").alias(name) for i, name in enumerate(stages)]
    return materialize(vectors.select(*[column(c) for c in keep], *named), "vectors", partition_by, rows_per_file)


def vector_columns(
    df: DataFrame, features: list[str], vector: str = "features", keep: Iterable[str] = ()
) -> DataFrame:
    """One ``*_scaled`` double column per vector entry, plus the columns to keep."""
    values = df.select(*[column(c) for c in keep], vector_to_array(vector).alias("__values"))
    return values.select(
        *[column(c) for c in keep],
        *[F.col("__values")[i].alias(scaled(f)) for i, f in enumerate(features)],
    )


def preprocess_status(model: PipelineModel) -> DataFrame:
    """How many features a fitted pipeline imputes, assembles and scales, as one row."""
    imputer = next(s for s in model.stages if isinstance(s, ImputerModel))
    count = len(imputer.getInputCols())
    return imputer.surrogateDF.select(F.lit(count).alias("num_features"))


def top_feature_slicer(importances, k: int) -> VectorSlicer:
    """Stage that keeps the ``k`` most important entries of the feature vector."""
    order = sorted(range(len(importances)), key=lambda i: (-importances[i], i))
    return VectorSlicer(inputCol="features", outputCol="top_features", indices=sorted(order[:k]))
