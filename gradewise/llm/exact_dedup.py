"""Copies of whole texts, found by skew-safe combining.

1. Locally: the partial aggregation joins equal texts of a task before anything moves.
2. Salted: groups meet by digest, salt and full text, so a text held by a third of all
   rows is spread over ``salts`` tasks.
3. Globally: the salts' winners, at most ``salts`` rows per text, meet by digest and full text.

Equality is always that of the folded text itself. The digest only deals rows out, and
leads rows back to their winner where it names one text; where two texts share a digest
(with a weak ``digest``) rows are led back by their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.llm.text import fold_case, fresh
from gradewise.sources.scratch import materialize


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _winners(rows: DataFrame) -> DataFrame:
    """Per text: digest, largest id, number of rows; the text too if its digest has several."""
    salted = rows.groupBy("digest", "salt", "folded").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy("digest", "folded").agg(
        F.max("top").alias("keep_id"), F.sum("n").alias("group_size")
    )
    # Texts per digest: one, but for collisions. Counted on digests alone, so no text moves again.
    found = materialize(merged.select("digest", "keep_id", "group_size"), "copies")
    shared = found.groupBy("digest").count().filter("count > 1").select("digest")
    if shared.isEmpty():
        return found.withColumn("folded", F.lit(None).cast("string"))
    return merged.join(shared.withColumn("several", F.lit(True)), "digest", "left").select(
        "digest", "keep_id", "group_size", F.when(F.col("several"), F.col("folded")).alias("folded")
    )


def _members(docs: DataFrame, text: str, key: str, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    folded = fold_case(column(text))
    return docs.select(
        column(key).alias("id"),
        folded.alias("folded"),
        digest(folded).alias("digest"),
        F.pmod(F.xxhash64(column(key)), F.lit(salts)).alias("salt"),
    )


def _with_winner(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Each row with its text's winner. The many rows of a hot digest meet one row; AQE splits them."""
    if "folded" in winners.columns and not winners.filter("folded IS NOT NULL").isEmpty():
        alone = rows.join(winners.filter("folded IS NULL").drop("folded"), "digest")
        shared = rows.join(winners.filter("folded IS NOT NULL"), ["digest", "folded"])
        return alone.unionByName(shared.select(alone.columns))
    return rows.join(winners.drop("folded"), "digest")


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is the empty text. The
    largest key of a group stays. Rows that repeat the winning key and text count as that
    document and are all marked kept. Null keys lose against any other; in a group of
    null keys alone ``keep_id`` is null and all stay. Columns of ``docs`` other than text
    and key play no part. An empty table gives an empty one.
    """
    rows = _members(docs, text, key, salts, digest)
    slim = rows.select("id", "digest", "folded", F.sha2("folded", 256).alias("text_sha256"))
    return _with_winner(slim, _winners(rows)).select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in ``exact_groups``."""
    winners = _winners(_members(docs, text, key, salts, digest))
    folded = fold_case(column(text))
    names = {n: fresh(docs, n) for n in ("digest", "folded")}
    rows = docs.withColumns({names["digest"]: digest(folded), names["folded"]: folded})
    w = winners.select([F.col(c).alias(f"won_{c}") for c in winners.columns]).alias("w")
    same = (
        (column(names["digest"]) == F.col("w.won_digest"))
        & column(key).eqNullSafe(F.col("w.won_keep_id"))
        & (F.col("w.won_folded").isNull() | (column(names["folded"]) == F.col("w.won_folded")))
    )
    return rows.join(w, same, "left_semi").select(*[column(c) for c in docs.columns])
