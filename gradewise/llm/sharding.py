"""Shards of near equal bytes, by histogram sort.

Rows are sorted by a 32-digit key: the hash of the text, then the hash of the row's id.
Equal texts are neighbours, so a group of copies stays together unless a shard's end
must fall inside it, and even a text held by a third of all rows can be cut anywhere.

Splitters are found without moving rows: every round counts the exact bytes in the bins
of the key ranges that still hold a wanted end, three digits finer each time, until an
end is within tolerance or the range is one key. Rounds see keys and sizes only, and a
round returns at most 4,096 bins per end. Then the rows move once.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradewise.functions import column
from gradewise.sources.scratch import materialize

#: Hex digits a round adds; 16 ** 3 bins per wanted end.
DIGITS = 3
#: Digits that make a numbering cell, and those of the hash of the id in a hot cell.
CELL_DIGITS = 5
#: Above every key that starts with the digits before it.
END = "~"


def hex_hash(*values: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(*values)), 16, "0"))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text and one for its end; null has none but that."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float = 0.005) -> list[str]:
    """``n_shards - 1`` keys; shard j holds the keys from splitter j - 1 up to splitter j.

    ``keys`` has ``key`` (hex digits, equally long) and ``size``. Each end is off its
    place by at most ``tolerance`` of a shard's bytes, or lies at the nearer side of the
    one key that covers the place.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    wanted = {j: total * j / n_shards for j in range(1, n_shards)}
    slack = tolerance * total / n_shards
    splitters: dict[int, str] = {}
    open_ranges = {j: ("", 0) for j in wanted}
    while open_ranges:
        prefixes = sorted({p for p, _ in open_ranges.values()}, key=len, reverse=True)
        bin_of = F.lit(None).cast("string")
        for p in reversed(prefixes):
            bin_of = F.when(F.col("key").startswith(p), F.substring("key", 1, len(p) + DIGITS)).otherwise(bin_of)
        counted = (
            keys.select(bin_of.alias("bin"), "key", "size")
            .filter("bin IS NOT NULL")
            .groupBy("bin")
            .agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        counted.sort(key=lambda r: r.bin)
        still = {}
        for j, (prefix, below) in open_ranges.items():
            splitters[j] = prefix + END
            for r in counted:
                if not r.bin.startswith(prefix) or len(r.bin) != min(len(prefix) + DIGITS, 32):
                    continue
                if below + r.size < wanted[j]:
                    below += r.size
                    continue
                before, after = wanted[j] - below, below + r.size - wanted[j]
                if min(before, after) <= slack or r.low == r.high:
                    splitters[j] = r.low if before <= after else r.high + END
                else:
                    still[j] = (os.path.commonprefix([r.low, r.high]), below)
                break
        open_ranges = still
    return [splitters[j] for j in range(1, n_shards)]


def _small(table: DataFrame, most: int = 100_000) -> DataFrame:
    """Marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def shard_documents(
    docs: DataFrame,
    n_shards: int = 16,
    text: str = "text",
    key: str = "doc_id",
    size: Column | None = None,
    text_hash: Column | None = None,
    tolerance: float = 0.005,
    cell_rows: int = 200_000,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... in each shard).

    Shards are ranges of the key of near equal bytes, and slots follow the key's order.
    Null and empty texts weigh one byte. Rows that repeat id and text have one key and
    are in one shard, in any order. Fewer rows than shards leave shards empty. A column
    of ``docs`` called shard or slot is replaced. ``size`` and ``text_hash`` may be given
    where ``docs`` already has them, so the text need not be there.

    Slots need no shard in one task: keys are cut into cells by their first digits, a
    cell of over ``cell_rows`` rows further by the id's hash, cells are counted, and a row
    is numbered inside its cell.
    """
    base = [column(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    first = text_hash if text_hash is not None else hex_hash(F.coalesce(column(text), F.lit("")))
    rows = docs.select(
        F.struct(*base).alias("row"),  # so that no name of theirs can clash
        F.concat(first, hex_hash(column(key), first)).alias("key"),
        (size if size is not None else text_bytes(column(text))).alias("size"),
    )
    keys = materialize(rows.select("key", "size"), "shard-keys")
    splitters = find_splitters(keys, n_shards, tolerance)
    shard = sum([(F.col("key") >= s).cast("int") for s in splitters], F.lit(0)).cast("int")

    plain = F.substring("key", 1, CELL_DIGITS)
    crowded = keys.groupBy(plain.alias("crowded")).count().filter(F.col("count") > cell_rows).select("crowded")
    crowded = _small(materialize(crowded, "crowded-cells"))

    def with_cell(df: DataFrame) -> DataFrame:
        fine = F.substring("key", 1, 16 + CELL_DIGITS)
        cell = F.when(F.col("crowded").isNull(), plain).otherwise(fine)
        return df.join(crowded, plain == F.col("crowded"), "left").withColumns({"cell": cell, "shard": shard})

    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        with_cell(keys)
        .groupBy("shard", "cell")
        .count()
        .select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    )
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key")) - 1
    return (
        with_cell(rows)
        .join(starts, ["shard", "cell"])
        .withColumn("slot", (F.col("start") + inside).cast("long"))
        .select("row.*", "shard", "slot")
    )
