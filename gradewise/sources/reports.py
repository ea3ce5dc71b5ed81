"""Report tables with fixed decimals, written as JSON or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from gradewise.functions import column

# Decimals in reports, names of the two model variants, metrics reported.
DECIMALS = 4
BASE = "base"
OPTIMISED = "optimised"
METRICS = ("accuracy", "precision", "recall", "f1", "auc")


def fixed_decimals(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Every fractional column rounded to the report's decimals."""
    fractional = (DoubleType, FloatType)
    return df.select(
        *[
            F.round(column(f.name), decimals).alias(f.name)
            if isinstance(f.dataType, fractional)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def metric_report(metrics: DataFrame, variant: str | None = None) -> DataFrame:
    """Metrics in long form ``(variant, metric, value)`` with fixed decimals."""
    if variant is not None:
        metrics = metrics.withColumn("variant", F.lit(variant))
    long = metrics.unpivot("variant", list(METRICS), "metric", "value")
    return fixed_decimals(long)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a report, replacing ``path``. Reports hold a row per model, feature or metric."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
