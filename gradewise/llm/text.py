"""Expressions and small helpers that several operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The letters that are folded, the bytes that count as white space.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"

#: Text handled at once inside a Python task; longer single texts stand alone.
BATCH_BYTES = 4_000_000


def fold_case(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null gives the empty text.

    Texts of ASCII only take the built-in ``lower``, which is much faster.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash_pair(*values: Column) -> list[Column]:
    """Two 64-bit hashes that together name the values."""
    return [F.xxhash64(F.lit(part), *values) for part in (0, 1)]


def fresh(df: DataFrame | Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}
    while name.lower() in taken:
        name = "_" + name
    return name


def show_code(df: DataFrame) -> None:
    """Let Python workers look for this package where the driver found it.

    On a cluster, where it is installed or shipped with the job, the path does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = df.sparkSession.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def batches(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[range]:
    """Ranges of neighbouring texts of at most ``limit`` bytes in all, or of one text."""
    first, held = 0, 0
    for place, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield range(first, place)
            first, held = place, 0
        held += len(text)
    if first < len(texts):
        yield range(first, len(texts))


def utf8(texts) -> list[bytes]:
    """The texts of an Arrow array as UTF-8, null as empty."""
    import pyarrow as pa

    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
