"""Records of delimited files whose quoted cells span lines, put together split by split.

Whether a line starts inside a quoted cell depends on all lines before it, so Spark reads
such a file in one task. But a line, and so a split, is a map: it turns the state at its start
into one at its end. Tasks read splits without knowing their states. They join lines to records
as soon as only one state is left possible, which the first quote tells as a rule, and state
how what they pass on looks for either state. The maps of a file's splits, one row for each,
are then composed in order, which gives every split its state. What a split's ends cut in two
meets in a shuffle of those fragments only.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradewise.sources.scratch import materialize

#: States: between records or in a cell without quotes, inside a quoted cell, and unclear how a reader takes it.
OUTSIDE, INSIDE, UNCLEAR = 0, 1, 2

#: Text that a task holds before it passes it on, and that of a record that is longer.
BATCH_CHARS = 4_000_000
BATCH_ROWS = 10_000

PIECES = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("header", pa.bool_()), ("text", pa.string())]
    + [(name, pa.int8()) for name in ("in_outside", "in_inside", "out_outside", "out_inside")]
)
PIECES_DDL = (
    "file string, block long, place long, header boolean, text string, "
    "in_outside byte, in_inside byte, out_outside byte, out_inside byte"
)
SPLITS_DDL = "file string, block long, state byte, is_sure boolean"


def line_ends(line: Column, sep: str) -> tuple[Column, Column]:
    """The state after a line that starts outside a quoted cell, and after one that starts inside.

    Clear are cells in quotes, with backslashes before quotes and backslashes in them, and
    cells that do not begin with a quote, whatever quotes they hold later.
    """
    edge = "\\x{%x}" % ord(sep)
    blank = rf"[\x00-\x20&&[^{edge}]]"
    plain = F.regexp_replace(line, r'\\["\\]', "x")
    # Cells from left to right: closed ones vanish, one that stays open or ends unclearly keeps the whole rest.
    cells = rf'(?s)(?<![^{edge}])(?:"[^"]*+"(?![^{edge}])|(?!{blank}*+")[^{edge}]++|({blank}*+".*+))'

    def after_cells(text: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(text, cells, "$1"), f"^{edge}*+", "")
        return F.when(rest == "", OUTSIDE).when(rest.rlike(r'^"[^"]*+\z'), INSIDE).otherwise(UNCLEAR)

    beyond = F.regexp_replace(plain, r'(?s)^[^"]*+"', "")  # of the first quote
    # Most lines have no quote, which takes no regular expression to tell.
    unclear, quoted = line.contains("\r"), line.contains('"')
    blank_line = (F.length(line) > 0) & (F.length(F.btrim(line, F.lit("".join(map(chr, range(33)))))) == 0)
    outside = (
        F.when(unclear | blank_line, UNCLEAR).when(~quoted, OUTSIDE).otherwise(after_cells(plain))
    )
    inside = (
        F.when(unclear, UNCLEAR)
        .when(~quoted | ~plain.contains('"'), INSIDE)
        .when(beyond == "", OUTSIDE)
        .when(F.substring(beyond, 1, 1) == sep, after_cells(F.substr(beyond, F.lit(2))))
        .otherwise(UNCLEAR)
    )
    return outside, inside


class _Split:
    """The lines of one split so far, for either state at its start."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.place = file, block, 0
        # A file starts outside.
        self.states = (OUTSIDE, INSIDE if block else UNCLEAR)
        self.held: list[str] = []
        self.before = self.states
        self.header = block == 0

    def known(self) -> int | None:
        """The state, once both starts agree on it or one of them is impossible."""
        live = {s for s in self.states if s != UNCLEAR}
        return live.pop() if len(live) == 1 else None if live else UNCLEAR

    def add(self, line: str, outside: int, inside: int) -> tuple | None:
        """Take a line; return the piece that is complete with it, if one is."""
        if line == "" and not self.held and self.known() == OUTSIDE:
            return None
        if not self.held:
            self.before = self.states
        self.held.append(line)
        follow = (outside, inside, UNCLEAR)
        was_known = self.known() is not None
        self.states = (follow[self.states[0]], follow[self.states[1]])
        # Lines of a quoted cell stay together when it is certain that they are.
        return None if was_known and self.known() == INSIDE else self.take()

    def take(self) -> tuple | None:
        if not self.held:
            return None
        ended = self.states
        if self.header and self.known() == INSIDE:
            ended = (UNCLEAR, UNCLEAR)  # a header longer than a split
        text = "\n".join(self.held)
        piece = (self.file, self.block, self.place, self.header, text, *self.before, *ended)
        self.held, self.place, self.header = [], self.place + 1, False
        return piece


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records where the state is known, single lines where it is not, and what is cut at a split's ends."""

    def found() -> Iterator[tuple]:
        split = None
        for batch in batches:
            for file, block, line, outside, inside in zip(*[c.to_pylist() for c in batch.columns]):
                if split is None or (file, block) != (split.file, split.block):
                    if split is not None:
                        yield split.take()
                    split = _Split(file, block)
                yield split.add(line, outside, inside)
        if split is not None:
            yield split.take()

    rows, size = [], 0
    for piece in found():
        if piece is None:
            continue
        rows.append(piece)
        size += len(piece[4])
        if size >= BATCH_CHARS or len(rows) >= BATCH_ROWS:
            yield _as_batch(rows)
            rows, size = [], 0
    if rows:
        yield _as_batch(rows)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, field.type) for c, field in zip(zip(*rows), PIECES)]
    return pa.RecordBatch.from_arrays(arrays, schema=PIECES)


def _composed(splits: pa.Table) -> pa.Table:
    """The state at the start of each split of one file, and if all of the file is clear."""
    rows = sorted(splits.to_pylist(), key=lambda r: r["block"])
    state, states = OUTSIDE, []
    for row in rows:
        states.append(state)
        state = (row["out_outside"], row["out_inside"], UNCLEAR)[state]
    return pa.table(
        {
            "file": pa.array([r["file"] for r in rows], pa.string()),
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "state": pa.array(states, pa.int8()),
            "is_sure": pa.array([state == OUTSIDE] * len(rows), pa.bool_()),
        }
    )


def spanning_records(spark: SparkSession, files: list[str], sep: str) -> tuple[DataFrame, list[str]]:
    """Column ``record`` with the text of each record of ``files`` but headers, and the files left out as unclear.

    The text is read once and stored with the records put together as far as their split
    shows them; nothing that follows depends on splits that could change between reads. A
    file is unclear if a cell that starts with a quote ends otherwise than with a quote
    before a separator or line end, and if its last one does not end. Empty lines between
    records are no records.
    """
    outside, inside = line_ends(F.col("value"), sep)
    lines = spark.read.text(files, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        outside.alias("outside"),
        inside.alias("inside"),
    )
    pieces = materialize(lines.mapInArrow(_pieces, PIECES_DDL), "pieces")
    last = pieces.groupBy("file", "block").agg(
        F.max_by(F.struct("out_outside", "out_inside"), "place").alias("last")
    )
    # A group holds a row per split of one file.
    splits = materialize(
        last.select("file", "block", "last.*").groupBy("file").applyInArrow(_composed, SPLITS_DDL), "splits"
    )
    unclear = [unquote(r.file) for r in splits.filter("not is_sure").select("file").distinct().collect()]
    starts_outside = F.col("state") == OUTSIDE
    placed = pieces.join(splits.filter("is_sure"), ["file", "block"]).select(
        "file",
        "block",
        "place",
        "header",
        "text",
        F.when(starts_outside, F.col("in_outside")).otherwise(F.col("in_inside")).alias("before"),
        F.when(starts_outside, F.col("out_outside")).otherwise(F.col("out_inside")).alias("after"),
    )
    is_whole = (F.col("before") == OUTSIDE) & (F.col("after") == OUTSIDE)
    whole = placed.filter(is_whole & ~F.col("header") & (F.col("text") != "")).select(F.col("text").alias("record"))
    # Fragments are those of records that a split's end cuts, or that come before a split's first quote.
    number = F.sum((F.col("before") == OUTSIDE).cast("long")).over(
        Window.partitionBy("file").orderBy("block", "place")
    )
    cut = (
        placed.filter(~is_whole)
        .withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("fragments"))
        .select(F.array_join("fragments.text", "\n").alias("record"))
    )
    return whole.unionAll(cut), unclear
