"""How far each source's word use lies from its language's other sources, and by which terms.

Each partition folds whole documents into stripes in a hash table: a term's document
frequency and its occurrences by source. A table that holds ``MAX_CELLS`` counts is spilled
and begun anew, so memory depends on neither the partition nor the number of sources.
Stripes are merged by language and term, which is the only shuffle of the corpus's size.
The merged stripes of the terms that are frequent enough are written, their sums give the
groups' totals, and blocks of stripes then emit partial divergences of all pairs of sources
and the block's best terms of each source. A block meets its language's totals in the
stream, ahead of its stripes, so nothing is broadcast or collected.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.llm.text import show_code, utf8
from gradewise.sources.scratch import materialize

# What a probability is scaled to, and what every count is raised by.
SCALE = 1_000_000_000
PRIOR = 5

#: Counts that a task's stripes hold before they are spilled.
MAX_CELLS = 200_000
#: Text whose words are counted at a time.
PIECE_BYTES = 1_000_000
#: Stripes or partial results sent on at a time.
BATCH_ROWS = 10_000
#: Counts of a block of stripes: at least, and at most.
BLOCK_CELLS = (1 << 14, 1 << 22)

# Terms are runs of ASCII letters and of anything beyond ASCII; only A-Z are lower-cased.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

STRIPE = "lang string, term string, cells array<struct<source: string, n: bigint>>"
PARTIAL = "part string, lang string, source string, item string, value bigint"
PARTIAL_ARROW = pa.schema(
    [(name, pa.string()) for name in ("part", "lang", "source", "item")] + [("value", pa.int64())]
)


def count_terms(text: bytes) -> Counter:
    """Occurrences by term of one whole text."""
    spaced = text.translate(TERM_BYTES)
    counts: Counter = Counter()
    start = 0
    while start < len(spaced):
        end = spaced.find(b" ", start + PIECE_BYTES)
        end = len(spaced) if end < 0 else end
        counts.update(spaced[start:end].split())
        start = end
    return counts


def _spill(stripes: dict[str, dict[bytes, dict]]) -> Iterator[pa.RecordBatch]:
    cell = pa.struct([("source", pa.string()), ("n", pa.int64())])
    for lang, terms in stripes.items():
        rows = list(terms.items())
        for at in range(0, len(rows), BATCH_ROWS):
            some = rows[at : at + BATCH_ROWS]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(some), pa.string()),
                    pa.array([term for term, _ in some], pa.string()),
                    pa.array([[(s, n) for s, n in counts.items()] for _, counts in some], pa.list_(cell)),
                ],
                ["lang", "term", "cells"],
            )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a partition's documents; the count under None is the document frequency."""
    stripes: dict[str, dict[bytes, dict]] = {}
    cells = 0
    for batch in batches:
        langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))
        for lang, source, text in zip(langs, sources, texts):
            terms = stripes.setdefault(lang, {})
            for term, n in count_terms(text).items():
                counts = terms.get(term)
                if counts is None:
                    counts = terms[term] = {None: 0}
                    cells += 1
                counts[None] += 1
                if source in counts:
                    counts[source] += n
                else:
                    counts[source] = n
                    cells += 1
            if cells >= MAX_CELLS:
                yield from _spill(stripes)
                stripes, cells = {}, 0
    yield from _spill(stripes)


def frequent_stripes(docs: DataFrame, min_docs: int, text: str, lang: str, source: str) -> DataFrame:
    """``lang, term, cells``: occurrences by source of the terms in at least ``min_docs`` documents of a language."""
    show_code(docs)
    rows = docs.select(
        F.coalesce(column(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(column(source).cast("string"), F.lit("")).alias("source"),
        column(text).alias("text"),
    )
    # Dealt out by term as stripes, so that their counts are added up without another shuffle.
    stripes = rows.mapInArrow(_fold, STRIPE).repartition("lang", "term")
    counts = (
        stripes.select("lang", "term", F.inline("cells"))
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"))
    )
    own = F.col("source").isNotNull()
    return (
        counts.groupBy("lang", "term")
        .agg(
            F.max(F.when(~own, F.col("n"))).alias("n_docs"),
            F.collect_list(F.when(own, F.struct("source", "n"))).alias("cells"),  # a cell per source
        )
        .filter(F.col("n_docs") >= min_docs)
        .select("lang", "term", "cells")
    )


def probabilities(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact for counts of any size."""
    if counts.size and int(counts.max()) >= (1 << 63) // SCALE - PRIOR:
        counts, totals = counts.astype(object), totals.astype(object)
    return (1 + SCALE * (counts + PRIOR) // (totals + PRIOR * terms)).astype(np.int64)


class _Block:
    """A language's totals and some of its stripes."""

    def __init__(self, lang: str, top: int):
        self.lang, self.top = lang, top
        self.sources: list[str] = []
        self.totals: list[int] = []
        self.n_terms = 0
        self.terms: list[str] = []
        self.cells: list[list[dict]] = []

    def rows(self) -> Iterator[tuple]:
        """Partial sums of all pairs, and the best terms of each source."""
        totals = np.array(self.totals, np.int64)
        place = {source: i for i, source in enumerate(self.sources)}
        counts = np.zeros((len(self.terms), len(self.sources)), np.int64)
        for i, cells in enumerate(self.cells):
            for cell in cells:
                counts[i, place[cell["source"]]] = cell["n"]
        p = probabilities(counts, totals, self.n_terms)
        for i, source in enumerate(self.sources):
            apart = np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(0)
            for j, value in enumerate(apart.tolist(), i + 1):
                yield "pair", self.lang, source, self.sources[j], value
        if not self.terms:
            return
        q = probabilities(counts.sum(1), totals.sum(), self.n_terms)
        above = np.where(counts > 0, p - q[:, None], 0)
        for i, source in enumerate(self.sources):
            own = above[:, i]
            found = ((-int(own[t]), self.terms[t].encode(), self.terms[t]) for t in np.flatnonzero(own > 0))
            for value, _, term in heapq.nsmallest(self.top, found):
                yield "term", self.lang, source, term, -value


def _emit(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """Partial divergences of the blocks of a partition, each block's totals ahead of its stripes."""

    def rows() -> Iterator[tuple]:
        block, name = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["block"]) != name:
                    if block is not None:
                        yield from block.rows()
                    block, name = _Block(row["lang"], top), (row["lang"], row["block"])
                if row["term"] is None:
                    block.sources.append(row["source"])
                    block.totals.append(row["n"])
                    block.n_terms = row["n_terms"]
                else:
                    block.terms.append(row["term"])
                    block.cells.append(row["cells"])
        if block is not None:
            yield from block.rows()

    held = []
    for row in rows():
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], schema=PARTIAL_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], schema=PARTIAL_ARROW)


def source_divergence(
    docs: DataFrame,
    min_docs: int = 30,
    top: int = 50,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every occurring pair of language and source.

    A language keeps the terms of at least ``min_docs`` of its documents. With n the count of
    such a term in a group, N the sum of n over kept terms and V their number, p is 1 +
    floor(SCALE * (n + PRIOR) / (N + PRIOR * V)). Part ``pair`` has a row for each other
    source of the language, valued by the sum over kept terms of the two p's distance, 0 if
    there are none. Part ``term`` has the ``top`` terms that the source uses more than its
    language does, valued by the distance from the language's p. Ranks go by falling value,
    then by item. All values are exact.

    A null text, language or source counts as empty. A row is a document, also one that
    repeats another. A source that is alone in its language has no pairs, one without terms
    has no terms but pairs like any other. An empty table gives an empty one. Other columns
    play no part.
    """
    stripes = materialize(frequent_stripes(docs, min_docs, text, lang, source), "term-stripes")
    groups = docs.select(
        F.coalesce(column(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(column(source).cast("string"), F.lit("")).alias("source"),
    ).distinct()
    sums = stripes.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    totals = materialize(
        groups.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")),
        "source-totals",
    )
    sizes = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    kept = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    least, most = BLOCK_CELLS
    # So many terms that a block's pairs are fewer than its counts, within what a task may hold.
    per_block = F.greatest(
        F.lit(1),
        F.least(
            F.floor(most / F.col("n_sources")), F.greatest(F.floor(least / F.col("n_sources")), 4 * F.col("n_sources"))
        ),
    )
    n_terms = F.coalesce("n_terms", F.lit(0))
    langs = materialize(
        sizes.join(kept, "lang", "left").select(
            "lang", n_terms.alias("n_terms"), F.greatest(F.lit(1), F.ceil(n_terms / per_block)).alias("n_blocks")
        ),
        "languages",
    )
    ahead = totals.join(langs, "lang").select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"),
        "source",
        "n",
        "n_terms",
        F.lit(None).cast("array<struct<source: string, n: bigint>>").alias("cells"),
    )
    inside = stripes.join(langs, "lang").select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("n_blocks")).alias("block"),
        "term",
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("long").alias("n"),
        "n_terms",
        "cells",
    )
    blocks = ahead.unionByName(inside).repartition("lang", "block")
    show_code(docs)
    partial = materialize(
        blocks.sortWithinPartitions("lang", "block", F.col("term").asc_nulls_first(), "source").mapInArrow(
            lambda batches: _emit(batches, top), PARTIAL
        ),
        "partial-divergences",
    )
    one_way = (
        partial.filter(F.col("part") == "pair")
        .groupBy("lang", "source", "item", "part")
        .agg(F.sum("value").alias("value"))
    )
    columns = ["lang", "source", "part", "item", "value"]
    pairs = one_way.select(columns).unionByName(
        one_way.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    )
    terms = partial.filter(F.col("part") == "term").select(columns)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    return (
        pairs.withColumn("rank", rank)
        .unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= top))
        .select(*columns, "rank")
    )
