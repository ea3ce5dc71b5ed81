"""Sources mixed to target weights, in fixed-length blocks of words.

1. Packing. A source's words form one stream, documents ordered by a hash of their key,
   and the stream is cut into blocks of ``block_words`` words (the last may be shorter).
   Streams are numbered cell by cell, so no task sees a whole source.
2. Shard counts. A source draws as many blocks as its target asks for, and a hash deals each
   draw to an output shard: the shards' counts of a source are one multinomial draw given
   its exact total. The counts are written, and a shard's slots of a source are numbered on
   from those of the shards before it.
3. Permutation. Slot k of a source with n blocks takes block p(k mod n), where p is a
   pseudorandom permutation of the source's block numbers, computed number by number. So a
   block is drawn again only after all others, and nothing is sorted or stored.
4. Join of draws and blocks by source and block number.

Targets and counts are small tables of sources; documents and draws are never collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradewise.functions import column
from gradewise.sources.scratch import materialize

# Fixed value: a word is a run of anything but these.
WORD = r"[^\x20\x09-\x0D]+"

#: Draws that one row is exploded into, and about as many times that are one task's.
DRAWS_PER_ROW = 1 << 14
ROWS_PER_TASK = 32
#: Cells a source's stream is numbered in.
CELLS = 4096
#: Rounds of the permutation.
ROUNDS = 24
#: Sources up to which their table is broadcast.
FEW_SOURCES = 50_000


@dataclass(frozen=True)
class MixPlan:
    """Weights repeat over the sources in order; the mix has ``share`` times all words."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most_epochs: int = 2
    block_words: int = 128
    n_shards: int = 64
    seed: int = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, plan: MixPlan) -> DataFrame:
    """Per source: number ``sid`` by code point, null last, ``source_size``, ``weight``, ``target``.

    ``sizes`` has ``source`` and ``size``. Targets share out the mix by weight; what is over
    ``most_epochs`` times a source goes to the others by weight until none is over. With
    sources ordered by cap per weight, those at their cap come first, and the first source
    whose fair part of the rest is within its cap ends them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rate = Window.orderBy("rate", "sid")
    before = rate.rowsBetween(Window.unboundedPreceding, -1)
    after = rate.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(w) for w in plan.weights])
    cap = plan.most_epochs * F.col("source_size")
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(weights, F.col("sid") % len(plan.weights)).cast("double"))
        .withColumn("total", F.lit(plan.share) * F.sum("source_size").over(everything))
        .withColumn("rate", cap / F.col("weight"))
    )
    level = (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(after)
    settled = named.withColumn("level", level).withColumn("free", F.col("level") <= F.col("rate"))
    final = F.min(F.when(F.col("free"), F.struct("rate", "sid", "level"))).over(everything)["level"]
    target = F.coalesce(F.least(F.col("weight") * final, cap.cast("double")), cap.cast("double"))
    return settled.select("source", "sid", "source_size", "weight", target.alias("target"))


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else table


def permuted(number: Column, n: Column, *keys: Column) -> Column:
    """Where a pseudorandom permutation of 0 to n - 1 sends ``number``.

    A swap-or-not shuffle: each round pairs x with (key - x) mod n, and a hash of the round
    and the pair's larger member tells both whether they change places.
    """

    def round_(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(r, *keys), n) - x, n)
        return F.when(F.xxhash64(*keys, r, F.greatest(x, partner)) % 2 == 0, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), number, round_)


def pack(rows: DataFrame, sources: DataFrame, plan: MixPlan) -> DataFrame:
    """``rows`` with ``sid``, ``start``: the place of their first word in their source's stream.

    ``rows`` has id, t (a hash of the text), source, size and anything else. Order in the
    stream is by hashes of the id and the text, then by the id. Rows equal in both follow
    each other in any order.
    """
    placed = rows.join(
        sources.select(F.col("source").alias("named"), "sid"), F.col("source").eqNullSafe(F.col("named"))
    ).drop("named")
    placed = placed.withColumns(
        {
            "place": F.xxhash64(F.lit(plan.seed), "id"),
            "cell": F.pmod(F.xxhash64(F.lit(plan.seed), "id", "t"), F.lit(CELLS)),
        }
    )
    cells = placed.groupBy("sid", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("sid", "cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("cell_start"))
    inside = Window.partitionBy("sid", "cell").orderBy("place", "id", "t")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        placed.join(cells, ["sid", "cell"])
        .withColumn("start", F.col("cell_start") + ahead)
        .drop("cell", "cell_start", "place")
    )


def _numbered(counted: DataFrame, count: str) -> DataFrame:
    """``counted`` once per ``number`` from 0 to ``count`` - 1, dealt out to tasks."""
    tops = F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / DRAWS_PER_ROW))
    first = F.col("piece") * DRAWS_PER_ROW
    numbers = F.sequence(first, F.least(first + DRAWS_PER_ROW, F.col(count)) - 1)
    # By number, since adaptive execution sees a few short rows and would make one task of them.
    total = counted.agg(F.sum(count)).first()[0] or 0
    tasks = max(1, ceil(total / (DRAWS_PER_ROW * ROWS_PER_TASK)), min(total // 10_000, 8))
    rows = counted.filter(F.col(count) > 0).withColumn("piece", F.explode(tops))
    spread = rows.repartition(tasks, *counted.columns, "piece")
    return spread.withColumn("number", F.explode(numbers)).drop("piece")


def shard_counts(sources: DataFrame, plan: MixPlan) -> DataFrame:
    """``sid``, ``n``, ``shard``, ``blocks``: what an output shard draws of a source with ``n`` blocks.

    A source's counts add up to its target in blocks. Shards that draw nothing of it have no row.
    """
    n = F.ceil(F.col("source_size") / plan.block_words)
    total = F.round(n * F.col("target") / F.col("source_size")).cast("long")
    counted = sources.filter("source_size > 0").select("sid", n.alias("n"), total.alias("draws"))
    shard = F.pmod(F.xxhash64(F.lit(plan.seed + 1), "sid", "number"), F.lit(plan.n_shards)).cast("int")
    return _numbered(counted, "draws").groupBy("sid", "n", shard.alias("shard")).agg(F.count(F.lit(1)).alias("blocks"))


def draws(counts: DataFrame, plan: MixPlan) -> DataFrame:
    """One row per slot of the ``counts``: ``sid``, ``shard``, ``k``, ``epoch`` and the ``block`` drawn.

    ``k`` numbers a source's slots, shard by shard.
    """
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("first", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)))
    slots = _numbered(first, "blocks").select("sid", "n", "shard", (F.col("first") + F.col("number")).alias("k"))
    return slots.select(
        "sid",
        "shard",
        "k",
        F.floor(F.col("k") / F.col("n")).cast("int").alias("epoch"),
        permuted(F.pmod("k", "n"), F.col("n"), F.lit(plan.seed), F.col("sid")).alias("block"),
    )


def pieces(packed: DataFrame, plan: MixPlan) -> DataFrame:
    """``packed`` once per block that a row reaches into: ``block``, ``first_word``, ``n_words`` of the row."""
    size, start, length = F.col("size"), F.col("start"), plan.block_words
    reached = F.sequence(F.floor(start / length), F.floor((start + size - 1) / length))
    first = F.greatest(F.col("block") * length - start, F.lit(0).cast("long"))
    last = F.least((F.col("block") + 1) * length - start, size)
    return packed.select("*", F.explode(reached).alias("block")).withColumns(
        {"first_word": first, "n_words": last - first}
    )


@dataclass
class Mix:
    """``documents``: id, t, size, sid, start of rows with words. ``empty``: id, source, size of the others.

    ``sources``: their targets. ``counts``: blocks per source and shard. ``drawn``: the draws.
    """

    documents: DataFrame
    empty: DataFrame
    sources: DataFrame
    counts: DataFrame
    drawn: DataFrame
    plan: MixPlan

    def slots(self) -> DataFrame:
        """The mix: per draw and document piece the shard, draw, epoch, id, first word and words."""
        # Hinted, here and below: by its origin in the few sources Spark takes the draws for small.
        return self.drawn.join(pieces(self.documents, self.plan).hint("merge"), ["sid", "block"]).select(
            "shard", "sid", "k", "epoch", "block", "id", "t", "start", "first_word", "n_words"
        )

    def taken(self) -> DataFrame:
        """One row per document: id, source, size, source_size, target, taken words, first and last shard.

        The shards are the smallest and largest that take any of its words, null without.
        """
        times = self.drawn.groupBy("sid", "block").agg(
            F.count(F.lit(1)).alias("times"), F.min("shard").alias("low"), F.max("shard").alias("high")
        )
        few = _small(self.sources)
        held = (
            pieces(self.documents, self.plan)
            .join(times.hint("merge"), ["sid", "block"], "left")
            .groupBy("sid", "start", "id", "size")  # a row of words is alone at its start
            .agg(
                F.sum(F.col("n_words") * F.coalesce("times", F.lit(0))).alias("taken"),
                F.min("low").alias("first_shard"),
                F.max("high").alias("last_shard"),
            )
            .join(few, "sid")
        )
        none = self.empty.withColumnRenamed("source", "named").join(
            few, F.col("named").eqNullSafe(F.col("source"))
        )
        columns = ["id", "source", "size", "source_size", "target"]
        nowhere = F.lit(None).cast("int")
        return held.select(*columns, "taken", "first_shard", "last_shard").unionByName(
            none.select(
                *columns,
                F.lit(0).cast("long").alias("taken"),
                nowhere.alias("first_shard"),
                nowhere.alias("last_shard"),
            )
        )

    def texts(self, rows: DataFrame, text: str) -> DataFrame:
        """``row``, ``kept``: a row per document and epoch that takes words of it, and these words' text.

        ``rows`` has id, t, source, size and the struct ``row`` that ``text`` is a field of. A
        text taken whole stays as it is; of others the taken words come with what follows them.
        """
        parts = (
            self.slots()
            .groupBy("sid", "start", "epoch")
            .agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("parts"))
            .withColumnsRenamed({"sid": "part_sid", "start": "part_start"})
        )
        placed = pack(rows.filter("size > 0"), _small(self.sources), self.plan)
        whole = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["n_words"]) == F.col("size")
        words = F.regexp_extract_all(F.col("row")[text], F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))

        def cut(ws: Column) -> Column:
            taken = F.transform(
                "parts",
                lambda p: F.array_join(F.slice(ws, (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), ""),
            )
            return F.array_join(taken, "")

        # Bound by an outer transform, so a text is split once and not once per part.
        some = F.get(F.transform(F.array(words), cut), 0)
        return placed.join(
            parts.hint("merge"), (F.col("sid") == F.col("part_sid")) & (F.col("start") == F.col("part_start"))
        ).select("row", F.when(whole, F.col("row")[text]).otherwise(some).alias("kept"))


def word_rows(docs: DataFrame, text: str, key: str, source: str, *more: Column) -> DataFrame:
    return docs.select(
        column(key).alias("id"),
        column(source).cast("string").alias("source"),
        F.xxhash64(F.coalesce(column(text), F.lit(""))).alias("t"),
        word_count(column(text)).alias("size"),
        *more,
    )


def mix_sources(
    docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", key: str = "doc_id", source: str = "source"
) -> Mix:
    """The mix of all rows of ``docs`` by ``plan``.

    Sizes are words; null and blank texts have none, belong to their source and are never
    taken. A null source is a source. Each source's taken words miss its target by less
    than two blocks, and no row is taken more than ``most_epochs`` times. Rows that repeat
    another are rows of their own. An empty table gives an empty mix. Other columns play
    no part. Reruns agree.
    """
    sizes = materialize(word_rows(docs, text, key, source), "word-counts")
    sources = materialize(source_targets(sizes, plan), "sources")
    packed = pack(sizes.filter("size > 0"), _small(sources), plan).drop("source")
    empty = sizes.filter("size = 0").select("id", "source", "size")
    counts = materialize(shard_counts(sources, plan), "shard-counts")
    return Mix(packed, empty, sources, counts, draws(counts, plan), plan)


def mixed_documents(
    docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", key: str = "doc_id", source: str = "source"
) -> DataFrame:
    """The mix as documents: the columns of ``docs``, a row per document and epoch with its taken words.

    Documents that the mix takes nothing of, and those without words, are left out. The
    text is the words that the epoch's blocks hold, in order; ``n_chars``, where there is
    such a column, is counted anew. Rules as in ``mix_sources``.
    """
    mix = mix_sources(docs, plan, text, key, source)
    row = F.struct(*[column(c) for c in docs.columns]).alias("row")
    kept = mix.texts(word_rows(docs, text, key, source, row), text)
    new = {text.lower(): F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(
        *[new.get(c.lower(), F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )
