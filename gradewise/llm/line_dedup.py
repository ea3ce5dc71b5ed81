"""Lines that many documents share, dropped everywhere but in one document.

Lines are exploded, normalised and hashed (two 64-bit hashes). A document gives each of
its keys once, so documents per key are a plain count that map tasks combine: a line
held by a third of all documents arrives as one row per map task. Only positions of
lines to drop go back to the documents, which are then put together by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.llm.text import SPACES, fold_case, hash_pair
from gradewise.sources.scratch import materialize

SPACE_CHARS = "".join(SPACES)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return fold_case(F.btrim(line, F.lit(SPACE_CHARS)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(column(text), F.lit("")), "\n", -1)


def shared_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """Hashes ``h0, h1`` of the keys that at least ``min_docs`` documents hold, and ``keeper``."""
    keys = F.filter(F.transform(_lines(text), line_key), lambda k: F.length(k) >= min_chars)
    held = docs.select(column(key).alias("id"), F.explode(F.array_distinct(keys)).alias("line"))
    h0, h1 = hash_pair(F.col("line"))
    return (
        held.select("id", h0.alias("h0"), h1.alias("h1"))
        .groupBy("h0", "h1")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
    )


def drop_shared_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_lines``, ``n_dropped`` and the ``kept_text``.

    Texts are split at line feeds; a null or empty text has one empty line. A key of at
    least ``min_chars`` code points that at least ``min_docs`` documents hold loses all its
    lines but those in the document with the largest key. Each row is a document, also
    one that repeats another's key; such rows keep or lose a line together. Null keys lose
    against others; among null keys alone a line stays everywhere. A document that loses
    all lines has an empty ``kept_text``. Other columns play no part.
    """
    # Written, so that both sides of the join are dealt out for it and a hot line can be split.
    shared = materialize(shared_lines(docs, text, key, min_chars, min_docs), "shared-lines")
    t0, t1 = hash_pair(F.coalesce(column(text), F.lit("")))
    rows = docs.select(column(key).alias("id"), _lines(text).alias("lines"), t0.alias("t0"), t1.alias("t1"))
    placed = rows.select("id", "t0", "t1", F.posexplode("lines").alias("place", "line"))
    line = line_key(F.col("line"))
    h0, h1 = hash_pair(line)
    gone = (
        placed.filter(F.length(line) >= min_chars)
        .select("id", "t0", "t1", "place", h0.alias("h0"), h1.alias("h1"))
        .join(shared, ["h0", "h1"])
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("gid"), F.col("t0").alias("g0"), F.col("t1").alias("g1"))
        .agg(F.collect_set("place").alias("gone"))
    )
    same = F.col("id").eqNullSafe(F.col("gid")) & (F.col("t0") == F.col("g0")) & (F.col("t1") == F.col("g1"))
    n_lines = F.size("lines")
    places = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.transform(places, lambda i: F.get(F.col("lines"), i))
    )
    return rows.join(gone, same, "left").select(
        F.col("id").alias(key),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept_text"),
    )
