"""Column choice, numeric casts, missing-value profile, text cleaning."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradewise.functions import column, is_missing, normalize_text, to_number

# Text columns cleaned when present, feature suffix and its exceptions,
# the share of missing cells from which a column counts as empty.
TEXT_COLUMNS = ("packaging", "labels", "categories", "ingredients_text")
FEATURE_SUFFIX = "_100g"
NOT_FEATURES = frozenset(
    {
        "nutrition_grade_fr",
        "nutrition_grade_uk",
        "nutrition-score-fr_100g",
        "nutrition-score-uk_100g",
    }
)
MAX_MISSING_SHARE = 0.999

Picker = Callable[[list[str]], list[str]]


def by_suffix(suffix: str = FEATURE_SUFFIX, exclude: Iterable[str] = NOT_FEATURES) -> Picker:
    """Picker of the columns that end in ``suffix``, minus ``exclude``."""
    excluded = set(exclude)
    return lambda names: [n for n in names if n.endswith(suffix) and n not in excluded]


def pick_columns(df: DataFrame, picker: Picker | None) -> list[str]:
    """Names the picker chooses; none without a picker."""
    return picker(df.columns) if picker is not None else []


def cast_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` as doubles, unreadable cells as null; one projection for all of them."""
    chosen = set(cols)
    return df.select(
        *[to_number(column(c)).alias(c) if c in chosen else column(c) for c in df.columns]
    )


def malformed_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, the cells that hold something but no number. One pass."""
    counts = [
        F.count_if(column(c).isNotNull() & to_number(column(c)).isNull()) for c in cols
    ]
    return _per_column(df, cols, counts, "malformed_count").drop("row_count")


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per numeric column, missing cells (null or NaN) and their share of all rows.

    One pass for all columns; on an empty table the share is null.
    """
    counts = [F.count_if(is_missing(column(c))) for c in cols]
    profile = _per_column(df, cols, counts, "null_count")
    return profile.withColumn("null_share", F.try_divide("null_count", "row_count"))


def _per_column(df: DataFrame, cols: list[str], counts: list, name: str) -> DataFrame:
    """One aggregate row turned into one row per column."""
    total = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*counts).alias("counts"))
    names = F.array(*[F.lit(c) for c in cols])
    return total.select("row_count", F.posexplode("counts").alias("position", name)).select(
        "position", F.element_at(names, F.col("position") + 1).alias("column"), "row_count", name
    )


def dense_profile(
    df: DataFrame, cols: list[str], max_share: float = MAX_MISSING_SHARE
) -> DataFrame:
    """The columns worth keeping: missing share strictly below ``max_share``, densest first."""
    kept = null_profile(df, cols).filter(F.col("null_share") < max_share)
    # One row per column of the table, so one window task is enough.
    rank = F.row_number().over(Window.orderBy("null_share", "position"))
    return kept.select(rank.alias("rank"), "column", "null_count", "null_share")


def dense_columns(
    df: DataFrame, cols: list[str], max_share: float = MAX_MISSING_SHARE
) -> list[str]:
    """Names from :func:`dense_profile`, densest first, ties in input order."""
    if not cols:
        return []
    return [r["column"] for r in dense_profile(df, cols, max_share).orderBy("rank").collect()]


def project(
    df: DataFrame, features: list[str], target: str | None = None, keep: Iterable[str] = ()
) -> DataFrame:
    """The kept features, then the target if the table has it, then the columns to carry."""
    extra = [c for c in [target, *keep] if c is not None and c in df.columns]
    return df.select(*[column(c) for c in dict.fromkeys([*features, *extra])])


def clean_text(df: DataFrame, cols: Iterable[str] = TEXT_COLUMNS) -> DataFrame:
    """Normalise those of ``cols`` that the table has."""
    chosen = set(cols)
    return df.select(
        *[normalize_text(column(c)).alias(c) if c in chosen else column(c) for c in df.columns]
    )


def clean(
    df: DataFrame,
    picker: Picker | None,
    target: str | None = None,
    text_columns: Iterable[str] = TEXT_COLUMNS,
    keep: Iterable[str] = (),
    max_share: float = MAX_MISSING_SHARE,
) -> tuple[DataFrame, list[str]]:
    """Cast, drop near-empty columns, normalise text, project. Returns table and features.

    Text is cleaned before the projection, so columns named in ``keep`` arrive clean.
    """
    picked = pick_columns(df, picker)
    numeric = cast_numeric(df, picked)
    features = dense_columns(numeric, picked, max_share)
    return project(clean_text(numeric, text_columns), features, target, keep), features


def clean_summary(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """Rows, numeric features and text features of a cleaned table, as one row."""
    return df.agg(F.count(F.lit(1)).alias("final_row_count")).select(
        "final_row_count",
        F.lit(len(numeric)).alias("numeric_features_count"),
        F.lit(len(text)).alias("categorical_features_count"),
    )


def undotted(name: str) -> str:
    """Dots become underscores, as ML stages cannot address dotted names."""
    return name.replace(".", "_")


def without_dots(df: DataFrame) -> DataFrame:
    """The table with :func:`undotted` column names."""
    renamed = [undotted(c) for c in df.columns]
    if len(set(renamed)) < len(renamed):
        raise ValueError(f"column names collide without their dots: {sorted(df.columns)}")
    return df.toDF(*renamed)
