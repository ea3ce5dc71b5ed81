"""The binary label: assign it, drop rows without one, count both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewise.functions import column, grade_label

LABEL = "label"


def assign_label(
    df: DataFrame,
    source: str,
    mapping: Callable[[Column], Column] = grade_label,
    label: str = LABEL,
) -> DataFrame:
    """Add the label that ``mapping`` makes of the source column; null where it makes none."""
    return df.withColumn(label, mapping(column(source)))


def drop_unlabelled(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Only the rows that have a label."""
    return df.dropna(subset=[label])


def label_stats(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives, positives and rows without label of the table before the drop. One pass."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label).isNull()).alias("discarded"),
    )


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Labelled rows per label, with their share."""
    counts = drop_unlabelled(df, label).groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    # One row per label reaches the window.
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy())
    return counts.withColumn("share", share)
