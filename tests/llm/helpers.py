"""Rows that are hard on operators, and ways to compare tables."""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRICKY = [
    (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a"),
    (2, "one TWO three four five six seven eight nine ten eleven twelve.", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n\n ", "en", "b"),
    (6, "Ünïcode Straße ÉCOLE\nline two\n\nline four ", "fr", "b"),
    (6, "Ünïcode Straße ÉCOLE\nline two\n\nline four ", "fr", "b"),
    (None, "no id here at all, and yet a text", "en", "a"),
    (None, None, None, None),
    (8, "word " * 30_000, "en", "a"),
    (9, "x" * 50_000, "en", None),
    (10, "漢字" * 3_000, "zh", "c"),
    (11, "One two three four five six seven eight nine ten eleven twelve.", "en", "a"),
]


def documents(spark, rows, **more) -> DataFrame:
    """Rows of (doc_id, text, lang, source) as a documents table, with extra columns."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    data = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    table = spark.createDataFrame(data, schema)
    return table.withColumns({name: F.lit(value) for name, value in more.items()})


def rows_of(df: DataFrame) -> list[str]:
    """All rows in an order of their own, comparable by ==."""
    return sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.collect())
