"""Reproducible splits, folds and class-balanced subsets (M1, M8).

All of them hash the row key, so membership does not change with partitioning,
cluster size or retries, and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewise.functions import column, hash_bucket, md5_of, row_key
from gradewise.functions.columns import HASH_RANGE
from gradewise.operators.labeling import LABEL

# The training share and the seed.
TRAIN_RATIO = 0.8
SEED = 42
# Hex digits of the hash by which a class is counted before the cut is sought: one task then
# ranks a 65,536th of it, whatever its size.
PREFIX_DIGITS = 4

#: Subsets that one number tells of.
MASK_BITS = 62


def identity(df: DataFrame, key: str) -> Column:
    """The key as text, or the hash of the row's content where the key is null."""
    return F.coalesce(column(key).cast("string"), row_key(df))


def _as_column(key: str | Column) -> Column:
    return column(key) if isinstance(key, str) else key


def in_train(key: str | Column, ratio: float = TRAIN_RATIO, seed: int = SEED) -> Column:
    """Does the row belong to the training part?

    Compares digests as text, which orders hex digits like the numbers they spell.
    """
    if ratio >= 1:
        return F.lit(True)
    return md5_of(_as_column(key), f"split:{seed}") < f"{int(ratio * HASH_RANGE):08x}"


def hash_split(
    df: DataFrame, key: str | None, ratio: float = TRAIN_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by key; rows without one, and tables without, are split by their content."""
    train = in_train(row_key(df) if key is None else identity(df, key), ratio, seed)
    return df.filter(train), df.filter(~train)


def random_split(
    df: DataFrame, ratio: float = TRAIN_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own split. It changes with the partitioning, which ``hash_split`` does not."""
    train, test = df.randomSplit([ratio, 1 - ratio], seed=seed)
    return train, test


def fold_of(key: str | Column, folds: int = 3, seed: int = SEED) -> Column:
    """Cross-validation fold of the row, independent of the split. ``identity`` serves tables with null keys."""
    return (hash_bucket(_as_column(key), f"fold:{seed}") % folds).cast("int")


def subset_conditions(
    df: DataFrame,
    key: str,
    label: str = LABEL,
    subsets: int = 5,
    seed: int = SEED,
) -> list[Column]:
    """Row conditions of class-balanced subsets, each class cut to the smallest one's size.

    A subset takes, of each larger class, the rows with the smallest salted key hashes.
    The cut-off hash is found by counting hash prefixes, then the hashes under the prefix
    that holds the cut, so no task sorts a class. Copies of one key stay together; with
    unique keys the classes come out exactly equal. Rows without key go by their content.
    """
    equal, larger, target = _class_sizes(df, label)
    if not larger:
        return [equal] * subsets
    who = identity(df, key)
    targets = {(value, i): target for value in larger for i in range(subsets)}
    # A row is hashed for all subsets at once.
    hashes = F.array(
        *[F.struct(F.lit(i).alias("subset"), _subset_hash(who, seed, F.lit(i)).alias("hash")) for i in range(subsets)]
    )
    rows = df.filter(F.col(label).isin(list(larger))).select(label, hashes.alias("hashes"))
    cutoffs = _cutoff_hashes(rows, label, targets)
    return [
        reduce(
            lambda a, b: a | b,
            [
                (F.col(label) == value) & (_subset_hash(who, seed, F.lit(i)) <= cutoffs[value, i])
                for value in larger
            ],
            equal,
        )
        for i in range(subsets)
    ]


def _class_sizes(df: DataFrame, label: str) -> tuple[Column, dict, int]:
    """Condition of the classes that are not cut, sizes of the larger ones by label, and the size they are cut to."""
    sizes = {
        r[label]: r["n"]
        for r in df.dropna(subset=[label])
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    target = min(sizes.values(), default=0)
    larger = {value: size for value, size in sizes.items() if size > target}
    return F.col(label).isNotNull() & ~F.col(label).isin(list(larger)), larger, target


def store_subsets(
    df: DataFrame,
    key: str,
    store: Callable[[DataFrame, list[str]], DataFrame],
    label: str = LABEL,
    subsets: int = 5,
    seed: int = SEED,
) -> tuple[DataFrame, list[Column]]:
    """What ``store`` writes of ``df``, and on it the conditions of ``subset_conditions``; rows are hashed in that one pass.

    ``store`` is given the rows and the names of columns to keep beside its own and the label.
    Hashes are even, so a cut lies near the share that a class is cut to: of a row near it the hash is
    kept, of any other row only on which side it is, as a bit of a mask. Cuts are then sought among
    the kept hashes. One that is elsewhere, as copies of few keys can move it, is found by hashing again.
    """
    equal, larger, target = _class_sizes(df, label)
    who, places = identity(df, key), range(subsets)
    hashes = {f"__hash_{i}": F.when(F.col(label).isin(list(larger)), _subset_hash(who, seed, F.lit(i))) for i in places}
    ends = {value: _near_cut(target, size) for value, size in larger.items()}

    def told(i: int, tell: Callable[[Column, str, str], Column]) -> Column:
        each = [(F.col(label) == value) & tell(F.col(f"__hash_{i}"), *ends[value]) for value in larger]
        return reduce(lambda a, b: a | b, each, F.lit(False))

    below = [equal | told(i, lambda h, low, high: h < low) for i in places]
    near = {f"__near_{i}": F.when(told(i, lambda h, low, high: (h >= low) & (h < high)), F.col(f"__hash_{i}")) for i in places}
    masks = subset_masks(below)
    marked = df.withColumns(hashes).withColumns(masks | near).drop(*hashes)
    stored = store(marked, [*masks, *near])
    inside = [in_subset(i) for i in places]
    if not larger:
        return stored, inside
    cut = stored.filter(F.col(label).isin(list(larger)))
    counted = cut.groupBy(label).agg(
        *[F.count_if(c).alias(f"below_{i}") for i, c in enumerate(inside)],
        *[F.count(f"__near_{i}").alias(f"near_{i}") for i in places],
    )
    counts = {r[label]: r for r in counted.collect()}
    targets = {(value, i): target - counts[value][f"below_{i}"] for value in larger for i in places}
    if not all(0 < wanted <= counts[value][f"near_{i}"] for (value, i), wanted in targets.items()):
        masks = subset_masks(subset_conditions(df, key, label, subsets, seed))
        return store(df.withColumns(masks), list(masks)), inside
    kept = F.array(*[F.struct(F.lit(i).alias("subset"), F.col(f"__near_{i}").alias("hash")) for i in places])
    rows = cut.filter(F.coalesce(*near).isNotNull()).select(label, kept.alias("hashes"))
    cutoffs = _cutoff_hashes(rows, label, targets)
    return stored, [
        reduce(
            lambda a, b: a | b,
            [(F.col(label) == value) & (F.col(f"__near_{i}") <= cutoffs[value, i]) for value in larger],
            inside[i],
        )
        for i in places
    ]


def _near_cut(target: int, size: int) -> tuple[str, str]:
    """Least and first greater hash, as far as needed, of a stretch that holds the ``target``-th smallest of ``size``.

    By eight standard deviations of its place, and a 256th of all hashes for copies of keys.
    """
    share, around = target / size, 4 / size**0.5 + 1 / 256
    low, high = int((share - around) * HASH_RANGE), int((share + around) * HASH_RANGE)
    # "g" comes after every hex digit.
    return f"{max(low, 0):08x}", f"{high:08x}" if high < HASH_RANGE else "g"


def subset_masks(conditions: list[Column]) -> dict[str, Column]:
    """Which conditions hold, as bits of as many numbers as it takes."""
    return {
        f"__mask_{at // MASK_BITS}": subset_mask(conditions[at : at + MASK_BITS])
        for at in range(0, len(conditions), MASK_BITS)
    }


def subset_mask(conditions: list[Column]) -> Column:
    """The places of the conditions that hold, as bits of one number."""
    bits = [F.when(c, F.lit(1 << i).cast("long")).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def in_subset(i: int) -> Column:
    """Does the row's mask hold subset ``i``?"""
    return F.col(f"__mask_{i // MASK_BITS}").bitwiseAND(F.lit(1 << i % MASK_BITS)) != 0


def balanced_subsets(df: DataFrame, key: str, label: str = LABEL, subsets: int = 5, **options) -> DataFrame:
    """All subsets in long form: the table's rows once per subset that holds them."""
    conditions = subset_conditions(df, key, label, subsets, **options)
    members = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
    return df.withColumn("subset", F.explode(members))


def _subset_hash(who: Column, seed: int, subset: Column) -> Column:
    salted = F.concat(subset.cast("string"), F.lit(":"), who)
    return md5_of(salted, f"subset:{seed}")


def _cutoff_hashes(rows: DataFrame, label: str, targets: dict) -> dict:
    """Per class and subset of ``targets``, the hash of the row of that rank among the smallest.

    ``rows`` have a label and ``hashes``, an array of subset and hash. Both passes read a row's
    hashes for all subsets at once, and the second one explodes only those at a cut.
    """
    prefix = F.substring("hash", 1, PREFIX_DIGITS)
    present = rows.select(label, F.inline("hashes")).filter(F.col("hash").isNotNull())
    hashed = present.select(label, "subset", prefix.alias("prefix"))
    within = Window.partitionBy(label, "subset")
    counted = hashed.groupBy(label, "subset", "prefix").agg(F.count(F.lit(1)).alias("n"))
    last = counted.withColumn("upto", F.sum("n").over(within.orderBy("prefix")))

    def ranks(ranked: dict) -> Column:
        return F.coalesce(
            *[F.when((F.col(label) == value) & (F.col("subset") == i), F.lit(rank)) for (value, i), rank in ranked.items()]
        )

    # One row per class and subset: the prefix in which the target rank falls.
    target = ranks(targets)
    cuts = last.filter((F.col("upto") >= target) & (F.col("upto") - F.col("n") < target)).collect()

    def at_cut(h: Column) -> Column:
        start = F.substring(h["hash"], 1, PREFIX_DIGITS)
        cut = [(F.col(label) == c[label]) & (h["subset"] == c["subset"]) & (start == c["prefix"]) for c in cuts]
        return reduce(lambda a, b: a | b, cut)

    near = rows.select(label, F.filter("hashes", at_cut).alias("hashes")).filter(F.size("hashes") > 0)
    at_hash = near.select(label, F.inline("hashes")).groupBy(label, "subset", "hash").agg(F.count(F.lit(1)).alias("n"))
    ranked = at_hash.withColumn("upto", F.sum("n").over(within.orderBy("hash")))
    wanted = ranks(
        {(c[label], c["subset"]): targets[c[label], c["subset"]] - (c["upto"] - c["n"]) for c in cuts}
    )
    found = ranked.filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted))
    return {(r[label], r["subset"]): r["hash"] for r in found.collect()}
